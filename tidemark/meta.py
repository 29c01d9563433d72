"""Names and constants shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

# Tables, feeds and downstream SQL rely on these exact texts.
RECORD_ID = "hs_object_id"
MODIFIED_AT = "hs_lastmodifieddate"
SYNCED_AT = "fivetran_synced"
DELETED = "fivetran_deleted"
DEFAULT_CATEGORY = "HUBSPOT_DEFINED"
LOCAL_ZONE = "America/Bogota"
MAX_NAME = 63
STAGE_PREFIXES = [
    "hs_v2_cumulative_time_in",
    "hs_v2_date_entered",
    "hs_v2_date_exited",
    "hs_v2_latest_time_in",
    "hs_time_in",
    "hs_date_exited",
    "hs_date_entered",
]

EDGE_KEY = ["from_id", "to_type", "to_id", "type_id"]
#: Where an edge was told: in its record (``INLINE``) or by the link feed of one target type. Each origin
#: speaks for its own edges only.
EDGE_ORIGIN = "_origin"
INLINE = "inline"
#: All properties of a record as they came, declared or not, where a table keeps them.
RAW = "_properties"
#: Edge tables are bucketed by these; a from-id's edges are dealt over so many salts.
EDGE_PLACE = ["from_id", "_salt"]
EDGE_SALTS = 8


@dataclass(frozen=True)
class MetaColumns:
    """The bookkeeping columns of a synchronised table."""

    id: str = RECORD_ID
    modified: str = MODIFIED_AT
    synced: str = SYNCED_AT
    deleted: str = DELETED

    @property
    def reserved(self) -> tuple[str, str, str]:
        return self.id, self.synced, self.deleted
