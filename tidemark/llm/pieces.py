"""SentencePiece encoding and decoding by an agenda of adjacent symbol pairs.

For vocabularies of merge type (BPE). The text is normalised as the model says and taken apart into
code points. An agenda holds every pair of neighbours that together make a piece, best score first and
of equal scores the leftmost; the pair on top is merged, its two new neighbourhoods enter the agenda,
and entries whose symbols have changed meanwhile are passed over. What is no piece in the end becomes
its UTF-8 bytes, or the unknown id where the model has no bytes.

No merge ever crosses a place that no piece spans, so a text is cut there and each stretch has an agenda
of its own; short stretches recur and are remembered, up to ``MAX_KEPT`` of them in a worker process. A text that offers no
such place is one stretch, in memory linear in its length.

Every Arrow batch is also encoded by the sentencepiece library, and ``agrees`` says for each row
whether both gave the same ids. Decoding is the library's. No row is shuffled; the driver reads the
model file and broadcasts it (at most ``MAX_MODEL`` bytes, or the call fails).

A null text counts as empty, and an empty one is begin and end alone. Bytes that are no UTF-8 count as
U+FFFD. Rows that repeat, or have no id, are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import math
import re
import struct
import sys
import types
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import documents

#: Fixed value: the mark that stands for a space.
SPACE = "▁"
MODEL = "piece_bpe_32k.model"
MAX_MODEL = 64 << 20
MAX_KEPT = 900_000
#: Stretches of more code points seldom recur.
MAX_LENGTH = 48
#: The score of a pair that is no piece.
NONE = math.inf
#: Bytes of text that are encoded, checked and decoded at a time.
AT_ONCE = 4 << 20


def model_path(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    return str(path)


class Kept(dict):
    """Packed ids of stretches; what is missing is encoded, and forgotten with all else beyond a bound."""

    def __init__(self, ids_of: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.ids_of = ids_of

    def __missing__(self, stretch: str) -> bytes:
        ids = packed(self.ids_of(stretch))
        if len(stretch) <= MAX_LENGTH:
            if len(self) >= MAX_KEPT:
                self.clear()
            self[stretch] = ids
        return ids


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PairAgenda:
    """Encodes texts with the pieces, scores and byte ids of a loaded model."""

    def __init__(self, model) -> None:
        ids = range(model.get_piece_size())
        if any(model.is_unused(i) for i in ids):
            raise ValueError("a vocabulary with unused pieces is not supported")
        own = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i): i for i in own}
        self.rank = {piece: -model.get_score(i) for piece, i in self.ids.items()}
        self.bytes = [i for i in ids if model.is_byte(i)]
        self.unknown = model.unk_id()
        self.begin, self.end = (packed([i]) if i >= 0 else b"" for i in (model.bos_id(), model.eos_id()))
        self.normalize = model.normalize
        self.kept = Kept(lambda stretch: self.ids_of(self.merged(stretch)))
        self.stretches = self._stretches()

    def _stretches(self) -> re.Pattern[str]:
        """Cuts before a space mark that follows another letter, around ASCII letters that only ever
        stand alone, and between letters that no chain of pieces ties together, such as a word and
        the punctuation behind it."""
        longer = [p for p in self.ids if len(p) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer):
            return re.compile("(?s:.+)")
        kin: dict[str, set[str]] = {}
        for piece in longer:
            own = set(piece) - {SPACE}
            sets = {id(k): k for c in own if (k := kin.get(c))}
            both = own.union(*sets.values())
            kin.update(dict.fromkeys(both, both))
        most = max(kin.values(), key=len, default=set())
        rest = re.escape("".join(sorted(c for c in kin if c not in most)))
        alone = re.escape("".join(c for c in map(chr, range(128)) if c not in kin))
        kinds = [f"[{alone}]"] * bool(alone) + [f"{SPACE}*[{rest}]+"] * bool(rest)
        return re.compile("|".join([*kinds, f"{SPACE}*[^{SPACE}{alone}{rest}]+", f"{SPACE}+"]))

    def encode(self, text: str) -> bytes:
        """All ids of a text, begin and end included, as little-endian unsigned 32-bit numbers."""
        found = b"".join(map(self.kept.__getitem__, self.stretches.findall(self.normalize(text))))
        if not self.bytes:
            # Neighbouring unknowns are one.
            ids = np.frombuffer(found, "<u4")
            found = ids[np.append(True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown))[: len(ids)]].tobytes()
        return self.begin + found + self.end

    def merged(self, stretch: str) -> list[str]:
        """The symbols of a stretch when no pair of neighbours makes a piece any more."""
        if len(stretch) <= MAX_LENGTH:
            return self._merged_short(stretch)
        score = self.rank.get
        symbols = list(stretch)
        last = len(symbols)
        before, after = list(range(-1, last - 1)), list(range(1, last + 1))
        pairs = enumerate(map(str.__add__, symbols, symbols[1:]))
        agenda = [(rank, left, pair) for left, pair in pairs if (rank := score(pair)) is not None]
        heapify(agenda)
        while agenda:
            _, left, pair = heappop(agenda)
            # A symbol that was merged is longer than it was, and one that was taken in is empty.
            right = after[left]
            if right == last or not symbols[left] or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            beyond, ahead = after[right], before[left]
            after[left] = beyond
            if beyond < last:
                before[beyond] = left
                wider = pair + symbols[beyond]
                if (rank := score(wider)) is not None:
                    heappush(agenda, (rank, left, wider))
            if ahead >= 0:
                wider = symbols[ahead] + pair
                if (rank := score(wider)) is not None:
                    heappush(agenda, (rank, ahead, wider))
        return [s for s in symbols if s]

    def _merged_short(self, stretch: str) -> list[str]:
        """The same with an agenda that is searched for its best entry, which is quicker for few pairs."""
        score, symbols = self.rank.get, list(stretch)
        agenda = [score(pair, NONE) for pair in map(str.__add__, symbols, symbols[1:])]
        while agenda and (best := min(agenda)) != NONE:
            left = agenda.index(best)
            pair = symbols[left] + symbols[left + 1]
            symbols[left : left + 2] = [pair]
            del agenda[left]
            if left < len(agenda):
                agenda[left] = score(pair + symbols[left + 1], NONE)
            if left:
                agenda[left - 1] = score(symbols[left - 1] + pair, NONE)
        return symbols

    def ids_of(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for symbol in symbols:
            known = self.ids.get(symbol)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out += [self.bytes[b] for b in symbol.encode("utf-8")]
            else:
                out.append(self.unknown)
        return out


def resident(held: bytes) -> tuple:
    """The model and its agenda, which a Python worker keeps for its next task."""
    import sentencepiece

    kept = sys.modules.setdefault("_resident_pieces", types.ModuleType("_resident_pieces")).__dict__
    if kept.get("held") != held:
        model = sentencepiece.SentencePieceProcessor(model_proto=held)
        kept.update(held=held, pair=(model, PairAgenda(model)))
    return kept["pair"]


def slices(texts: list[str], most: int = AT_ONCE) -> Iterator[slice]:
    """Stretches of a list that hold about ``most`` letters, or one longer text."""
    start = held = 0
    for n, text in enumerate(texts):
        if n > start and held + len(text) > most:
            yield slice(start, n)
            start, held = n, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


ENCODED = ["doc_id", "ids", "decoded", "agrees"]


def encode_pieces(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded, agrees`` of every row.

    ``ids`` are little-endian unsigned 32-bit numbers in a row, as training files hold them, with the
    model's begin and end; ``decoded`` is the text that they stand for.
    """
    with open(model_path(path), "rb") as file:
        held = file.read(MAX_MODEL + 1)
    if len(held) > MAX_MODEL:
        raise ValueError(f"the model has more than {MAX_MODEL} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, agenda = resident(sent.value)
        for batch in batches:
            texts = [b.decode("utf-8", "replace") for b in batch.column(1).to_pylist()]
            for part in slices(texts):
                own = texts[part]
                # Nothing here is cyclic, and looking for cycles takes a tenth of the time.
                gc.disable()
                ids = [agenda.encode(t) for t in own]
                gc.enable()
                told = model.encode_as_numpy(own, add_bos=True, add_eos=True, num_threads=1)
                decoded = model.decode([np.frombuffer(i, "<u4").tolist() for i in ids], num_threads=1)
                columns = [
                    batch.column(0)[part],
                    pa.array(ids, pa.binary()),
                    pa.array(decoded, pa.string()),
                    pa.array([a == b.astype("<u4").tobytes() for a, b in zip(ids, told)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=ENCODED)

    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), raw.alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids binary, decoded string, agrees boolean")


def op11_sentencepiece(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    coded = encode_pieces(documents(spark, folder), path)
    return coded.select(
        "doc_id",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )
