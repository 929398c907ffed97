"""Token counts under a unigram model, computed once per shared prefix of the pre-tokens."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def unigram_scores(model_path: str = DEFAULT_MODEL) -> dict[str, float]:
    """Piece to score. The file ranks its pieces; a piece of rank r gets -log(r + 2), as Zipf's law has it."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model_path)
    out = {}
    for i in range(pieces.get_piece_size()):
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i)):
            out[pieces.id_to_piece(i)] = -math.log(i + 2)
    return out


class PrefixCounts:
    """Forward scores down the trie of distinct pre-tokens.

    Pre-tokens in order are the trie in depth-first order: what a pre-token shares with the one before
    is kept on the stack, and only its own tail is computed. A state is the best score of the prefix and
    the tokens of that segmentation; ties go to fewer tokens. A character without a piece costs one
    token per UTF-8 byte.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.worst = min(scores.values(), default=-1.0) - 10
        self.steps = 0

    def count(self, pretokens: Iterable[str]) -> dict[str, int]:
        get, longest, worst = self.scores.get, self.longest, self.worst
        counts: dict[str, int] = {}
        before, stack = "", [(0.0, 0)]
        for word in sorted(set(pretokens)):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del stack[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                self.steps += 1
                n_bytes = len(word[end - 1].encode("utf-8", "surrogatepass"))
                score, tokens = stack[end - 1]
                best = (score + worst * n_bytes, -tokens - n_bytes)
                for start in range(max(0, end - longest), end):
                    piece = get(word[start:end])
                    if piece is not None:
                        score, tokens = stack[start]
                        best = max(best, (score + piece, -tokens - 1))
                stack.append((best[0], -best[1]))
            counts[word] = stack[-1][1]
            before = word
        return counts


def token_counts(docs: DataFrame, scores: dict[str, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_pretokens, n_tokens.

    A pre-token is a run without white space, with the word mark before it. Documents are counted batch
    by batch; no text leaves its task. Counts of pre-tokens of up to 24 characters are kept between
    batches while there are fewer than 500,000. Null text is empty: 0 and 0. Rows stay as they are,
    repeated or not; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, kept = PrefixCounts(shared.value), {}
        for b in batches:
            words = [Counter((t or "").split()) for t in b["t"]]
            counts = trie.count({MARK + w for c in words for w in c} - kept.keys())
            kept.update(counts)
            tokens = [sum(n * kept[MARK + w] for w, n in c.items()) for c in words]
            kept = {w: n for w, n in kept.items() if len(w) <= 24} if len(kept) < 500_000 else {}
            yield pd.DataFrame({"k": b["k"].astype("Int64"), "n_pretokens": [c.total() for c in words], "n_tokens": tokens})

    given = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return given.mapInPandas(measure, "k long, n_pretokens long, n_tokens long").withColumnRenamed("k", key)
