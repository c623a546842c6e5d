"""Token counts: best unigram segmentation of pre-tokens, computed once per prefix in a trie."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD

#: Where the public vocabulary lies; a parameter of the operator, never copied.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
#: The trie starts anew beyond so many nodes: its memory is bounded, its counts don't change.
MAX_NODES = 400_000


def unigram_scores(path: str = VOCABULARY) -> dict[str, float]:
    """Log-scores of a public vocabulary's pieces: Zipf's law over their rank, as the vocabulary
    lists them by falling frequency and states no probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = (model.is_control, model.is_unknown, model.is_byte)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(f(i) for f in skip)]
    return {piece: -math.log(rank + 2.7) for rank, piece in enumerate(pieces)}


class Trie:
    """Pre-tokens by character; each node holds the forward score and token count of its prefix.

    A character outside the vocabulary stands as its UTF-8 bytes, each a token of the least score.
    Of equal scores the segmentation with fewer tokens counts.
    """

    def __init__(self, scores: dict[str, float], max_nodes: int = MAX_NODES) -> None:
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.least = min(scores.values(), default=0.0) - 1.0
        self.max_nodes = max_nodes
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.count = [0.0], [0]

    def insert(self, word: str) -> tuple[int, float]:
        """Tokens and score of ``word``, the values stored at its terminal node."""
        if len(self.best) > self.max_nodes:
            self.clear()
        child, best, count, scores = self.child, self.best, self.count, self.scores
        path, node = [0], 0
        for end, char in enumerate(word, 1):
            after = child.get((node, char))
            if after is None:
                units = len(char.encode())
                before = path[-1]
                top, n = best[before] + units * self.least, count[before] + units
                for start in range(max(0, end - self.longest), end):
                    own = scores.get(word[start:end])
                    if own is not None:
                        total, tokens = best[path[start]] + own, count[path[start]] + 1
                        if total > top or total == top and tokens < n:
                            top, n = total, tokens
                after = child[node, char] = len(best)
                best.append(top)
                count.append(n)
            node = after
            path.append(node)
        return count[node], best[node]


_SPLIT = re.compile(WORD)


def count_batch(texts: list[str], trie: Trie) -> pd.DataFrame:
    """Words, tokens and score of each text; each distinct word of the batch is looked up once."""
    split = [_SPLIT.findall(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = pa.array([w for own in split for w in own], pa.string()).dictionary_encode()
    distinct = flat.dictionary.to_pylist()
    order = sorted(range(len(distinct)), key=distinct.__getitem__)  # prefixes stay in the cache
    tokens, scores = np.zeros(len(distinct), np.int64), np.zeros(len(distinct))
    for i in order:
        tokens[i], scores[i] = trie.insert(SPACE_MARK + distinct[i])
    at = flat.indices.to_numpy()
    ends = np.cumsum(sizes)
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[at])])[np.concatenate([[0], ends])])
    return pd.DataFrame({"n_words": sizes, "n_tokens": sums(tokens), "log_score": sums(scores)})


def count_tokens(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = VOCABULARY,
) -> DataFrame:
    """One row per row of ``df``: its id, n_words (pre-tokens), n_tokens and log_score of the best
    segmentation, over the whole text.

    Pre-tokens are the words between ASCII white space, each with a leading mark. Null and empty
    texts have no tokens; repeated rows and null ids keep a row each; other columns are ignored.
    The vocabulary is read on the driver and broadcast (its size doesn't depend on the data). Each
    task keeps a trie of bounded size over all its batches; nothing is shuffled.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(unigram_scores(path))

    @F.pandas_udf("n_words long, n_tokens long, log_score double")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trie = Trie(vocabulary.value)
        for texts in batches:
            yield count_batch([t or "" for t in texts], trie)

    rows = df.select(F.col(id_col), counted(F.col(text_col)).alias("_counts"))
    return rows.select(id_col, "_counts.*")
