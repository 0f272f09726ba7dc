"""Token counts by dynamic programming over a trie of pre-tokens.

A text's pre-tokens are its words, each with a leading blank mark.  A unigram
tokenizer splits a pre-token into vocabulary pieces of the largest total
score (fewest pieces among equals; a character outside the vocabulary costs
one byte token per byte).  The best score of a prefix does not depend on what
follows, so distinct pre-tokens are put into a trie and the forward scores of
a prefix are computed once for all pre-tokens that share it; a node where a
pre-token ends stores its token count.

Scale.  One pass without a shuffle: every task builds the trie of the distinct
pre-tokens of one slice of texts (about 8 MB) depth first, so that only the
scores along one path are held, and keeps the terminal counts for its texts.
Memory is bounded by the slice, however many documents there are.

Defined results: a null or empty text has no pre-tokens and no tokens.
Repeated rows give repeated results, other columns are ignored.  An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, field, slices, text_of

BLANK = "▁"  # marks the blank before a word
UNKNOWN_PENALTY = 10  # below the lowest piece score, for each byte of an unknown character
_SLICE_BYTES = 8 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with integer scores, and all endings of pieces (to know when to stop looking back)."""

    scores: dict[str, int]
    endings: frozenset[str]
    byte_score: int

    @classmethod
    def of(cls, pieces: dict[str, int]) -> Vocabulary:
        endings = frozenset(p[k:] for p in pieces for k in range(len(p)))
        return cls(pieces, endings, min(pieces.values(), default=0) - UNKNOWN_PENALTY)

    @classmethod
    def from_sentencepiece(cls, path: str) -> Vocabulary:
        """The ordinary pieces of a public sentencepiece model and their scores."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        named = {model.id_to_piece(i): round(model.get_score(i)) for i in plain}
        return cls.of({p: s for p, s in named.items() if p.strip(BLANK) or len(p) == 1})


def trie_counts(pre_tokens: list[str], vocabulary: Vocabulary) -> dict[str, tuple[int, int]]:
    """(score, number of tokens) of every distinct pre-token.

    Sorted order walks the trie depth first; ``score`` and ``count`` hold the
    forward values of the prefixes on the path to the current node.
    """
    scores, endings, byte_score = vocabulary.scores, vocabulary.endings, vocabulary.byte_score
    score, count, before, out = [0], [0], "", {}
    for text in sorted(pre_tokens):
        shared = 0
        for a, b in zip(before, text):  # noqa: B905  the shorter one ends the common prefix
            if a != b:
                break
            shared += 1
        del score[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(text) + 1):
            unknown = len(text[end - 1].encode("utf-8", "replace"))
            best, least = score[end - 1] + unknown * byte_score, count[end - 1] + unknown
            start = end - 1
            while start >= 0 and (piece := text[start:end]) in endings:
                if piece in scores:
                    value = score[start] + scores[piece]
                    if value > best or (value == best and count[start] + 1 < least):
                        best, least = value, count[start] + 1
                start -= 1
            score.append(best)
            count.append(least)
        out[text] = (score[-1], count[-1])
        before = text
    return out


def count_tokens(
    docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: id, ``n_pre_tokens``, ``n_tokens``, ``forward_score`` (sum of the best scores)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, _SLICE_BYTES):
            texts = [t.split() for t in byte_values(batch, 1)]
            words = list(set().union(*texts))
            marked = [BLANK + w.decode("utf-8", "replace") for w in words]
            found = trie_counts(marked, vocabulary)
            number = dict(zip(words, range(len(words)), strict=True))
            values = np.array([found[m] for m in marked], dtype=np.int64).reshape(-1, 2)
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            ids = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
            sums = np.zeros((len(ids) + 1, 2), dtype=np.int64)
            np.cumsum(values[ids], axis=0, out=sums[1:])
            ends = np.cumsum(sizes)
            totals = sums[ends] - sums[ends - sizes]
            arrays = [batch.column(0), pa.array(sizes), pa.array(totals[:, 1].copy()), pa.array(totals[:, 0].copy())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = T.StructType([field(docs, id_column)])
    for name in ("n_pre_tokens", "n_tokens", "forward_score"):
        schema = schema.add(name, T.LongType())
    names = schema.names
    return docs.select(F.col(id_column), text_of(text_column).alias("text")).mapInArrow(count, schema)
