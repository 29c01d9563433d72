"""Benchmark decontamination by BM25 retrieval with block-max WAND.

The test items are the indexed side. Each term has a posting list of (item, impact), sorted by item,
and the largest impact in every block of ``BLOCK`` items where it occurs; an impact is the term's
BM25 weight in the item over the sum of all weights of the item, so a passage that holds every term
of an item scores 1 for it. Items go by classes of length, and for each class a document is cut into
overlapping passages of at least twice the longest length of the class, half of which overlap; so every
stretch as long as an item lies whole in one passage, and no item's passages depend on another class.
Every passage is a query. Its terms' block maxima are added up for all blocks at once; in the blocks
that can reach ``MIN_SCORE``, WAND moves from pivot to pivot, and so all items that score as much
are retrieved. A retrieved item counts as leaked if at least
``MIN_OVERLAP`` of the word n-grams of its question and of its answer are in the passage. The answer
is an item's last sentence, or its last third if it has but one sentence.

Numbers of items, lengths and frequencies of terms are counted over all items by Spark. Tasks build the
index in chunks, of one class and at most about ``CHUNK_BYTES`` of item text (or one longer item) each, and
write them to the shared folder; the tasks of one pass over the documents read the chunks in turn while
they hold a batch of texts. The driver sees file names only, and the result is the same for any number of
chunks. ``pyarrow`` must be able to open the folder of ``spark.checkpoint.dir``.

Words are what stands between ASCII white space and punctuation, with A-Z in lower case. Null or
empty texts hold and match nothing, and so do items of fewer than ``least_words`` (``GRAM`` unless given)
words, which say too little to be told from ordinary text; if they are looked for, items of fewer than
``GRAM`` words must be in a passage as a whole, word for word. Rows that repeat an item id, or have none, are items of their
own; the answer names ids, so repeated ones come once. The same holds for documents. An empty table on
either side gives no rows.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import documents, table
from tidemark.session import write_once, write_result

K1, B = 1.2, 0.75
MIN_SCORE = 0.6
MIN_OVERLAP = 0.6
GRAM = 5
BLOCK = 4
PASSAGE = 128
#: Passages of a document that are looked at together.
AT_ONCE = 256
#: Two ways to add up the same impacts may differ by this.
SLACK = 1e-6
CHUNK_BYTES = 8 << 20

#: ASCII letters fold, ASCII punctuation separates.
_FOLD = bytes(
    ord(chr(c).lower()) if chr(c).isascii() and chr(c).isalpha() else c if c >= 128 or chr(c).isdigit() else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of an item, as words."""
    sentences = [w for s in re.split(r"(?<=[.!?])\s+", text) if (w := words_of(s))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = words_of(text)
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def ngrams(ids: list[int], n: int) -> set[tuple[int, ...]]:
    return set(zip(*(ids[k:] for k in range(n))))


class ItemIndex:
    """An inverted index of a chunk of items.

    ``items`` holds (id, terms of the question, terms of the answer), ``postings`` holds (items,
    impacts, largest impact): all plain values, so that :meth:`of` restores an index from them.
    """

    def __init__(self, rows: list[Row], n_items: int, mean_length: float) -> None:
        self.terms: dict[bytes, int] = {}
        self.items: list[tuple] = []
        found: dict[int, list[tuple[int, float]]] = {}
        for r in rows:
            question, answer = split_item(r.text)
            words = question + answer
            df = {t.term.encode("utf-8", "surrogatepass"): t.df for t in r.terms}
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words]
            weights = {}
            for w, t in zip(words, ids):
                tf = words.count(w) if t not in weights else 0
                if tf:
                    idf = np.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5))
                    norm = tf + K1 * (1 - B + B * len(words) / mean_length)
                    weights[t] = float(idf * tf * (K1 + 1) / norm)
            whole = sum(weights.values())
            for t, weight in weights.items():
                found.setdefault(t, []).append((len(self.items), weight / whole))
            self.items.append((r.item_id, ids[: len(question)], ids[len(question) :]))
        self.postings = {
            t: ([r[0] for r in rows], [r[1] for r in rows], max(r[1] for r in rows))
            for t, rows in found.items()
        }
        self.tops = np.zeros(len(self.terms) + 1)
        # Blocks of every term and their maxima, term after term.
        first, blocks, maxima = [0], [], []
        for t in range(len(self.terms)):
            items, impacts, self.tops[t] = self.postings[t]
            own: dict[int, float] = {}
            for item, impact in zip(items, impacts):
                own[item // BLOCK] = max(own.get(item // BLOCK, 0.0), impact)
            blocks.extend(own)
            maxima.extend(own.values())
            first.append(len(blocks))
        self.first, self.blocks = np.array(first), np.array(blocks, np.int64)
        self.maxima, self.n_blocks = np.array(maxima), len(self.items) // BLOCK + 1

    @classmethod
    def of(cls, state: dict) -> ItemIndex:
        index = cls.__new__(cls)
        index.__dict__.update(state)
        return index

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Term numbers; -1 for words that no item has."""
        return np.fromiter(map(self.terms.get, words, repeat(-1)), np.int32, len(words))

    def retrieve(self, terms: list[int], block: int, least: float) -> list[tuple[int, float]]:
        """All items of a block whose impacts for ``terms`` (distinct) add up to at least ``least``."""
        end = (block + 1) * BLOCK
        # Of every term: its next item, the place in its list, the list and its impacts, its bound.
        lists = []
        for t in terms:
            items, impacts, top = self.postings[t]
            at = bisect_left(items, block * BLOCK)
            if at < len(items) and items[at] < end:
                lists.append((items[at], at, items, impacts, top))
        out = []
        while lists:
            lists.sort(key=itemgetter(0))
            bound, pivot = 0.0, None
            for item, *_, top in lists:
                bound += top
                if bound >= least:
                    pivot = item
                    break
            if pivot is None:
                break
            if lists[0][0] == pivot:
                score = sum(impacts[at] for item, at, _, impacts, _ in lists if item == pivot)
                if score >= least:
                    out.append((pivot, score))
                pivot += 1
            # Nothing before the pivot can reach the threshold.
            moved = []
            for cursor in lists:
                item, at, items, impacts, top = cursor
                if item < pivot:
                    at = bisect_left(items, pivot, at)
                    if at == len(items) or items[at] >= end:
                        continue
                    cursor = (items[at], at, items, impacts, top)
                moved.append(cursor)
            lists = moved
        return out

    def live(self, ids: np.ndarray, half: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """First word, block and distinct terms of the passages that may reach the threshold there."""
        n = max(1, -(-(len(ids) - half) // half))
        at = np.flatnonzero(ids >= 0)
        term, part = ids[at].astype(np.int64), at // half
        for low in range(0, n, AT_ONCE):
            # A passage is two halves, and each half is in two passages.
            passage = np.concatenate((part, part - 1)) - low
            inside = (passage >= 0) & (passage < min(AT_ONCE, n - low))
            pairs = np.unique(passage[inside] * len(self.tops) + np.concatenate((term, term))[inside])
            passage, terms = np.divmod(pairs, len(self.tops))
            bound = np.bincount(passage, self.tops[terms], AT_ONCE)
            able = bound[passage] >= MIN_SCORE - SLACK
            passage, terms = passage[able], terms[able]
            if not len(terms):
                continue
            counts = self.first[terms + 1] - self.first[terms]
            spot = np.arange(counts.sum()) + np.repeat(self.first[terms] - np.cumsum(counts) + counts, counts)
            cell = np.repeat(passage, counts) * self.n_blocks + self.blocks[spot]
            bounds = np.bincount(cell, self.maxima[spot])
            for c in np.flatnonzero(bounds >= MIN_SCORE - SLACK).tolist():
                p, block = divmod(c, self.n_blocks)
                lo, hi = np.searchsorted(passage, (p, p + 1))
                yield (low + p) * half, block, terms[lo:hi]

    def overlaps(self, item: int, passage: list[int]) -> tuple[float, float]:
        """Shares of the n-grams of question and answer that a passage has; all or nothing of a short item."""
        whole = [t for part in self.items[item][1:] for t in part]
        if len(whole) < GRAM:
            hit = float(tuple(whole) in ngrams(passage, len(whole)))
            return hit, hit
        shares = []
        for part in self.items[item][1:]:
            n = min(GRAM, len(part))
            own = ngrams(part, n) if n else set()
            shares.append(len(own & ngrams(passage, n)) / len(own) if own else 1.0)
        return shares[0], shares[1]

    def leaks(self, text: str | None, passage: int) -> dict[int | None, tuple[float, float, float, int]]:
        """Leaked items: score, overlaps of question and answer, and first word, of the best passage."""
        ids = self.ids(words_of(text))
        if not len(ids) or not self.items:
            return {}
        best: dict = {}
        for start, block, terms in self.live(ids, passage // 2):
            words = None
            for item, score in self.retrieve(terms.tolist(), block, MIN_SCORE - SLACK):
                words = words or ids[start : start + passage].tolist()
                question, answer = self.overlaps(item, words)
                if min(question, answer) >= MIN_OVERLAP:
                    key, found = self.items[item][0], (score, question, answer, start)
                    if key not in best or found[:3] > best[key][:3]:
                        best[key] = found
        return best


@F.pandas_udf(T.ArrayType(T.StringType()))
def item_words(texts: pd.Series) -> pd.Series:
    """Words of an item, long enough or not, as text."""
    found = [[w.decode("utf-8", "surrogatepass") for w in words_of(t)] for t in texts]
    return pd.Series(found, dtype=object)


def passage_of(words: int) -> int:
    """Words of a passage for the class of items that one of so many words belongs to."""
    return max(PASSAGE, 2 << max(0, words - 1).bit_length())


def index_files(items: DataFrame, least_words: int) -> list[str]:
    """Files of (passage, index) for all items of ``item_id, text``, written by tasks."""
    read = items.where("text is not null").select(
        "item_id", "text", item_words("text").alias("words"), F.monotonically_increasing_id().alias("rid")
    )
    read = write_once(read.where(F.size("words") >= max(1, least_words)), "items")
    tally = read.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean"), F.sum(F.octet_length("text")).alias("bytes")
    ).first()
    if not tally.n:
        return []
    n, mean = tally.n, tally.mean
    terms = read.select("rid", F.explode(F.array_distinct("words")).alias("term"))
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    listed = terms.join(df, "term").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("terms"))
    whole = read.join(listed, "rid").select("rid", "item_id", "text", "terms", F.size("words").alias("n_words"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list[Row], int]] = {}

        def made(passage: int) -> pd.DataFrame:
            rows = sorted(held.pop(passage)[0], key=lambda r: (r.item_id is not None, r.item_id or 0, r.text, r.rid))
            return pd.DataFrame({"passage": [passage], "state": [pickle.dumps(vars(ItemIndex(rows, n, mean)))]})

        for b in batches:
            for rid, item, text, found, n_words in zip(b["rid"], b["item_id"].astype("Int64"), b["text"], b["terms"], b["n_words"]):
                passage, size = passage_of(n_words), len(text.encode("utf-8", "surrogatepass"))
                if passage in held and held[passage][1] + size > CHUNK_BYTES:
                    yield made(passage)
                rows, used = held.get(passage, ([], 0))
                row = Row(rid=rid, item_id=None if item is pd.NA else int(item), text=text, terms=[Row(term=t["term"], df=t["df"]) for t in found])
                rows.append(row)
                held[passage] = rows, used + size
        for passage in sorted(held):
            yield made(passage)

    chunks = max(1, -(-tally.bytes // CHUNK_BYTES))
    # Texts are read once for each file, so there are as many files as the items need, however many
    # partitions a shuffle by key has.
    index = whole.repartition(chunks).mapInPandas(build, "passage int, state binary")
    return sorted(write_once(index, "item-index").inputFiles())


def read_indexes(files: list[str]) -> Iterator[tuple[int, ItemIndex]]:
    """The chunks in turn, one at a time."""
    import pyarrow.fs
    import pyarrow.parquet

    for file in files:
        uri = re.sub("^file:/+", "file:///", file)
        system, path = pyarrow.fs.FileSystem.from_uri(uri) if ":/" in uri else (pyarrow.fs.LocalFileSystem(), uri)
        with system.open_input_file(path) as opened:
            for batch in pyarrow.parquet.ParquetFile(opened).iter_batches(batch_size=1):
                for row in batch.to_pylist():
                    yield row["passage"], ItemIndex.of(pickle.loads(row["state"]))


def leaked_items(docs: DataFrame, items: DataFrame, least_words: int = GRAM) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, word_at`` of every leak."""
    files = index_files(items.select("item_id", "text"), least_words)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A single chunk stays; of several only one is held at a time.
        kept = list(read_indexes(files)) if len(files) == 1 else None
        for b in batches:
            for passage, index in kept if kept is not None else read_indexes(files):
                rows = [
                    (doc, item, *leak)
                    for doc, text in zip(b["doc_id"].astype("Int64"), b["text"])
                    for item, leak in index.leaks(text, passage).items()
                ]
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "q", "a", "at"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

    found = docs.select("doc_id", "text").mapInPandas(
        search, "doc_id long, item_id long, score double, q double, a double, at long"
    )
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "q", "a", "at")).alias("x"))
    return best.select(
        "doc_id",
        "item_id",
        F.col("x.score").alias("score"),
        F.col("x.q").alias("question_overlap"),
        F.col("x.a").alias("answer_overlap"),
        F.col("x.at").alias("word_at"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, least_words: int = GRAM) -> DataFrame:
    """The rows of ``docs`` without those that hold a leaked item, each judged by itself."""
    row = "_row"
    while row in map(str.lower, docs.columns):
        row += "_"
    # Written with its numbers, which would differ if the rows were read anew.
    numbered = write_once(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")

    def holders() -> DataFrame:
        leaked = leaked_items(numbered.select(F.col(row).alias("doc_id"), "text"), items, least_words)
        return leaked.select(F.col("doc_id").alias(row)).distinct()

    leaked = write_result(docs.sparkSession, holders, "leaked")
    return numbered.join(leaked, row, "left_anti").drop(row)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(documents(spark, folder), table(spark, folder, "benchmark"))
