"""Token counts under a unigram vocabulary, by dynamic programming on a trie.

A pre-token is a word with one space before it.  Its best segmentation into
vocabulary pieces maximises the sum of the pieces' unigram scores; the score of
the best segmentation of a prefix depends on the prefix alone, so it is computed
once for every node of a trie of the distinct pre-tokens, level by level, and
the node where a pre-token ends holds its count.  Distinct pre-tokens are
collected batch by batch inside a task: nothing is shuffled, and the work and
the memory follow the batch.

Scores come from the pieces' ranks in a public vocabulary (Zipf's law, in fixed
point, so sums are exact).  Ties go to the segmentation whose last piece is
shortest.

Cases: null or empty text counts nothing; a byte that is no piece of its own
costs one token at the lowest score; a null ``doc_id`` is left out; repeated
rows count once each; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import _SYMBOL, Spans, documents, record_batch, ship, steps, utf8, words
from pathcredit.llm.tokens import VOCABULARY

_FIXED = 1 << 20
_models: dict[str, "Unigram"] = {}


class Unigram:
    """Pieces by hash: the score and nothing else is needed to count."""

    def __init__(self, pieces: list[bytes]):
        n = len(pieces)
        total = float((1.0 / np.arange(1, n + 2)).sum())
        score = np.round(-np.log(np.arange(1, n + 1) * total) * _FIXED).astype(np.int64)
        self.unknown = int(round(-np.log((n + 1) * total) * _FIXED))
        size = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        end = np.cumsum(size)
        hashes = Spans(_SYMBOL[data]).hash(end - size, end)
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], score[order]
        self.longest = int(size.max())
        self.sizes = np.unique(size)

    @classmethod
    def public(cls, name: str) -> "Unigram":
        if name not in _models:
            import public_tokenizers as public

            with open(public.path(f"{name}.tiktoken"), "rb") as f:
                ranked = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, f))
            _models[name] = cls([p for _, p in ranked])
        return _models[name]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, self.scores[at]

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, score) of each distinct pre-token ``data[start:end]``: forward
        scores over the trie of their prefixes."""
        size = end - start
        order = np.argsort(-size, kind="stable")  # those that reach a level stand first
        start, size = start[order], size[order]
        spans = Spans(_SYMBOL[data])
        reach = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), "right")
        # per level: node of every pre-token that reaches it, and the nodes' best score and count
        node: list[np.ndarray] = [np.zeros(len(start), np.int64)]
        best, used = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        tokens, score = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for level, live in enumerate(reach.tolist(), 1):
            prefix = spans.hash(start[:live], start[:live] + level)
            _, one, own = np.unique(prefix, return_index=True, return_inverse=True)
            top = np.full(len(one), np.iinfo(np.int64).min)
            many = np.zeros(len(one), np.int64)
            tail = start[one] + level
            for length in self.sizes[self.sizes <= level].tolist() if 1 in self.sizes else [1, *self.sizes[self.sizes <= level].tolist()]:
                parent = node[level - length][one]
                known, worth = self.lookup(spans.hash(tail - length, tail))
                if length == 1:
                    worth, known = np.where(known, worth, self.unknown), np.ones(len(one), bool)
                value = best[level - length][parent] + worth
                better = known & (value > top)
                top[better] = value[better]
                many[better] = used[level - length][parent][better] + 1
            node.append(own)
            best.append(top)
            used.append(many)
            if level >= self.longest:  # older levels are out of every piece's reach
                node[level - self.longest] = best[level - self.longest] = used[level - self.longest] = None
            ends = np.flatnonzero(size[:live] == level)
            tokens[ends], score[ends] = many[own[ends]], top[own[ends]]
        out = np.empty_like(order)
        out[order] = np.arange(len(order))
        return tokens[out], score[out]


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("log_score", pa.float64())])


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: pre-tokens, tokens and the log score of the segmentation."""

    def run(batches):
        model = Unigram.public(vocabulary)
        for batch in steps(batches, 8 << 20):
            data, offsets = utf8(batch.column(1))
            start, end, first = words(data, offsets)
            if len(start):
                spans = Spans(_SYMBOL[data])
                _, one, own = np.unique(spans.hash(start, end), return_index=True, return_inverse=True)
                del spans
                # the distinct words, each behind one space
                size = end[one] - start[one]
                edge = np.cumsum(np.append(0, size + 1))
                text = np.full(edge[-1], 32, np.uint8)
                at = np.repeat(start[one] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                text[np.repeat(edge[:-1] + 1 - (np.cumsum(size) - size), size) + np.arange(size.sum())] = data[at]
                tokens, score = model.counts(text, edge[:-1], edge[1:])
                sums = [np.append(0, np.cumsum(x[own])) for x in (tokens, score)]
            else:
                sums = [np.zeros(1, np.int64)] * 2
            n, s = (x[first[1:]] - x[first[:-1]] for x in sums)
            yield record_batch(_COUNTS, batch.column(0), np.diff(first), n, s / _FIXED)

    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    return own.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, log_score double")


def op10_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir))
