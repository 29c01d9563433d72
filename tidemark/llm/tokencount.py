"""Token counts of a unigram segmentation, by dynamic programming on a trie.

A text is cut at ASCII white space; each word with the mark of a word's start before it is a
pre-token. Of all ways to write it as pieces of a vocabulary, the one of highest score counts: a piece
scores ``-log(rank + 2)`` for its rank in the vocabulary, as Zipf's law has it, and a character that
is no piece is written as its UTF-8 bytes, each scored as the vocabulary's last piece. Ties go to
fewer tokens.

The best score of a prefix depends on the prefix alone. So pre-tokens are put into a trie, each node
is scored once, from its ancestors, whatever number of pre-tokens runs through it, and a pre-token's
count is stored where it ends. Each task has a trie of its own over the pre-tokens it meets, started
anew beyond ``MAX_NODES`` nodes, which changes memory but no count; a long pre-token is scored on a
trie of its own. No row is shuffled. The vocabulary is broadcast and has at most ``MAX_PIECES``
pieces, or the call fails.

A null or empty text, or one of white space alone, has no tokens. Rows that repeat are counted each;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import documents

#: Fixed value: the mark that stands for the space before a word.
START = "▁"
MAX_PIECES = 1_000_000
MAX_NODES = 800_000
#: Pre-tokens of more characters share too few prefixes to stay in the trie.
MAX_LENGTH = 64
TOKENIZER = "piece_bpe_32k.model"


def read_pieces(path: str | None = None) -> list[str]:
    """The ordinary pieces of a SentencePiece file, in the order of its ids."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def piece_scores(pieces: list[str]) -> dict[str, float]:
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    scores: dict[str, float] = {}
    for rank, piece in enumerate(pieces):
        scores.setdefault(piece, -math.log(rank + 2))
    return scores


def suffix_table(scores: dict[str, float]) -> dict[str, float]:
    """Scores of pieces, and 0 for what is only the end of some piece."""
    table = dict.fromkeys((p[i:] for p in scores for i in range(len(p))), 0.0)
    return table | scores


class CountTrie:
    """Nodes of a trie with the best score, and its number of tokens, from the root to each.

    Edges are held as (node, letter) in one number. A node looks back over the ends of pieces only as
    far as there is a piece that ends so.
    """

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.table = suffix_table(scores)
        self.longest = max(map(len, scores), default=0)
        self.byte = -math.log(len(scores) + 2)
        self.clear()

    def clear(self) -> None:
        self.edges: dict[int, int] = {}
        self.best = [0.0]
        self.tokens = [0]
        self.counts: dict[bytes, int] = {}

    def insert(self, token: str) -> int:
        """The number of tokens of a pre-token; only nodes that are new are scored."""
        edges, best, tokens, ends = self.edges, self.best, self.tokens, self.table.get
        path, node = [0], 0
        for end, letter in enumerate(token, 1):
            edge = node << 21 | ord(letter)
            below = edges.get(edge)
            if below is None:
                top, fewest, start = -math.inf, 0, end - 1
                while start >= 0:
                    score = ends(token[start:end])
                    if score is None:
                        break
                    if score:
                        score += best[path[start]]
                        n = tokens[path[start]] + 1
                        if score > top or score == top and n < fewest:
                            top, fewest = score, n
                    start -= 1
                if not ends(letter):
                    n = len(letter.encode("utf-8", "surrogatepass"))
                    score, n = best[node] + n * self.byte, tokens[node] + n
                    if score > top or score == top and n < fewest:
                        top, fewest = score, n
                below = edges[edge] = len(best)
                best.append(top)
                tokens.append(fewest)
            node = below
            path.append(node)
        return tokens[node]

    def count(self, word: bytes) -> int:
        """The tokens of a word, from where its pre-token ends in the trie."""
        found = self.counts.get(word)
        if found is None:
            token = START + word.decode("utf-8", "surrogatepass")
            if len(token) > MAX_LENGTH:
                return long_count(self.scores, self.longest, self.byte, token)
            if len(self.best) > MAX_NODES:
                self.clear()
            found = self.counts[word] = self.insert(token)
        return found


def long_count(scores: dict[str, float], longest: int, byte: float, token: str) -> int:
    """The same for one pre-token that shares no nodes, in memory linear in its length."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        found = []
        for start in range(max(0, end - longest), end):
            score = scores.get(token[start:end])
            if score is not None:
                found.append((best[start][0] + score, best[start][1] - 1))
        if token[end - 1] not in scores:
            n = len(token[end - 1].encode("utf-8", "surrogatepass"))
            found.append((best[end - 1][0] + n * byte, best[end - 1][1] - n))
        best.append(max(found))
    return -best[-1][1]


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def count_tokens(docs: DataFrame, pieces: list[str]) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every row of ``doc_id, text``."""
    sent = docs.sparkSession.sparkContext.broadcast(piece_scores(pieces))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = CountTrie(sent.value)
        for b in batches:
            own = [words_of(t) for t in b["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"),
                    "n_pretokens": np.fromiter(map(len, own), np.int64, len(own)),
                    "n_tokens": np.fromiter((sum(map(trie.count, w)) for w in own), np.int64, len(own)),
                }
            )

    return docs.select("doc_id", "text").mapInPandas(
        count, "doc_id long, n_pretokens long, n_tokens long"
    )


def op8_token_counts(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    counted = count_tokens(documents(spark, folder), read_pieces(tokenizer))
    return counted.withColumn("tokens_per_word", F.col("n_tokens") / F.nullif("n_pretokens", F.lit(0)))
