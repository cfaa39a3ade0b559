"""Operator 3, token counts: trie-shared dynamic programming over distinct pre-tokens.

A batch's distinct pre-tokens go into a trie. When an insertion makes a node, the unigram forward score of its
prefix is computed from the nodes above it, once for all pre-tokens that share the prefix; the last node of a
pre-token stores the number of tokens of its best segmentation.

The unigram scores come from a public vocabulary file, whose pieces are ranked: piece r of V has the Zipf score
-log(r + 1). Nothing is trained. Characters outside the vocabulary cost one token for each UTF-8 byte.

Defined results: a null or empty text has no pre-tokens and 0 tokens; repeated rows are counted each; other
columns are not read. Of equally scored segmentations the one with fewer tokens counts.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_state

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
BYTE_SCORE = -16.0
NODE_LIMIT = 600_000
LONG_WORD = 4096


def load_scores(path: str | None = None) -> dict[str, float]:
    """Score of each ordinary piece of a sentencepiece file."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    ordinary = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    return {piece: -math.log(rank + 1) for rank, piece in enumerate(ordinary, 1)}


class Trie:
    """Nodes in parallel lists: children by (node, character), forward score, tokens of the best segmentation."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Number of tokens of a word."""
        if word in self.terminal:
            return self.terminal[word]
        if len(word) > LONG_WORD:
            return self.streamed(word)
        if len(self.score) > NODE_LIMIT:
            self.clear()
        path, node = [0], 0
        children, score, tokens, get = self.children, self.score, self.tokens, self.scores.get
        for end, char in enumerate(word, 1):
            child = children.get((node, char))
            if child is None:
                size = len(char.encode("utf-8", "surrogatepass"))
                above = path[end - 1]
                best = (score[above] + BYTE_SCORE * size, -tokens[above] - size)
                for begin in range(max(0, end - self.longest), end):
                    piece = get(word[begin:end])
                    if piece is not None:
                        above = path[begin]
                        best = max(best, (score[above] + piece, -tokens[above] - 1))
                child = len(score)
                children[node, char] = child
                score.append(best[0])
                tokens.append(-best[1])
            node = child
            path.append(node)
        self.terminal[word] = tokens[node]
        return tokens[node]


    def streamed(self, word: str) -> int:
        """The same for a word too long for nodes of its own: only scores within the longest piece's reach are held."""
        reach, get = deque([(0.0, 0)], self.longest), self.scores.get
        for end, char in enumerate(word, 1):
            size = len(char.encode("utf-8", "surrogatepass"))
            score, tokens = reach[-1]
            best = (score + BYTE_SCORE * size, tokens - size)
            for back in range(1, min(self.longest, end) + 1):
                piece = get(word[end - back : end])
                if piece is not None:
                    score, tokens = reach[-back]
                    best = max(best, (score + piece, tokens - 1))
            reach.append(best)
        return -reach[-1][1]


def count_tokens(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, n_chars, n_bytes) of every whole text; pre-tokens are the parts between white space, each after a word-start mark."""

    def run(batches):
        trie = worker_state(f"trie {path}", lambda: Trie(load_scores(path)))
        for batch in batches:
            out = [[], [], [], []]
            for text in batch.column("text").to_pylist():
                words = (text or "").split()
                total = sum([trie.insert(w) for w in map(SPACE.__add__, words)])
                for k, v in enumerate((len(words), total, len(text or ""), len((text or "").encode("utf-8", "surrogatepass")))):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(np.array(v, np.int64)) for v in out)], ["doc_id", "n_pretokens", "n_tokens", "n_chars", "n_bytes"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, n_chars long, n_bytes long")


def token_budget(documents: DataFrame, by: str = "source") -> DataFrame:
    """Tokens of each group of documents."""
    counts = count_tokens(documents)
    return documents.select("doc_id", by).join(counts, "doc_id").groupBy(by).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_documents"))
