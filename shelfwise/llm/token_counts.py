"""Count the tokens of texts under a unigram vocabulary: best segmentation of every distinct pre-token, found in a trie.

The distinct pre-tokens of a batch, in order, go into a trie. A node's best score and its number of tokens are
worked out from its ancestors when the node is made, so pre-tokens that share a prefix share the work; the end of
a pre-token stores its count. Texts then add up the counts of their pre-tokens. Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm import tables, words

GROUP_BYTES = 8 << 20
TRIE_WORDS = 50_000
KEPT_WORDS = 200_000
SPACE_MARK = "▁"
SCALE = 1_000_000


def zipf_vocabulary(model_path: str) -> dict[str, int]:
    """Pieces of a public sentence-piece file with scores in millionths of a natural logarithm.

    The file ranks its pieces without probabilities; by Zipf's law the r-th has one in proportion to 1 / (r + 1).
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(pieces.get_piece_size()) if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))]
    ranked = sorted(ids, key=lambda i: (-pieces.get_score(i), i))
    total = math.log(sum(1 / (r + 2) for r in range(len(ranked))))
    return {pieces.id_to_piece(i): round((-math.log(r + 2) - total) * SCALE) for r, i in enumerate(ranked)}


class Trie:
    """Pre-tokens with the best score and token count of every prefix.

    Ties go to fewer tokens. A character in no piece counts as its UTF-8 bytes, each scored below all pieces.
    """

    def __init__(self, scores: dict[str, int]):
        self.scores = scores
        self.longest = max(map(len, scores), default=0)
        self.byte = min(scores.values(), default=0) - 10 * SCALE
        self.next: dict[tuple[int, str], int] = {}
        self.best, self.count = [0], [0]

    def insert(self, word: str) -> int:
        """The number of tokens of ``word``."""
        path, node = [0], 0
        for i, c in enumerate(word):
            child = self.next.get((node, c))
            if child is None:
                n = len(c.encode("utf-8", "replace"))
                top = (self.best[node] + n * self.byte, -(self.count[node] + n))
                for size in range(1, min(i + 1, self.longest) + 1):
                    score = self.scores.get(word[i + 1 - size:i + 1])
                    if score is not None:
                        before = path[i + 1 - size]
                        top = max(top, (self.best[before] + score, -(self.count[before] + 1)))
                child = self.next[node, c] = len(self.best)
                self.best.append(top[0])
                self.count.append(-top[1])
            path.append(child)
            node = child
        return self.count[node]


def token_counts(docs: DataFrame, scores: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n_pretokens`` and ``n_tokens``; a pre-token is a word after the space mark.

    A null or empty text has none of either. Ids may be null or repeat, an empty table gives an empty result,
    other columns are ignored. The vocabulary is broadcast: its size is that of a tokenizer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    out = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            ids = batch.column("doc_id")
            for parts in words.groups(batch.column("text"), GROUP_BYTES):
                found, index = words.distinct(parts)
                if len(known) > KEPT_WORDS:
                    known.clear()
                new = sorted(w for w in found if w not in known)
                for at in range(0, len(new), TRIE_WORDS):
                    trie = Trie(shared.value)
                    for w in new[at:at + TRIE_WORDS]:
                        known[w] = trie.insert(SPACE_MARK + w.decode("utf-8", "replace"))
                per_word = np.fromiter((known[w] for w in found), np.int64, len(found))[index]
                begin = np.concatenate([[0], np.cumsum([p.n for p in parts])])
                row = np.concatenate([p.row + b for p, b in zip(parts, begin)])
                totals = np.bincount(row, weights=per_word, minlength=begin[-1]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(parts[0].first, int(begin[-1])), pa.array(np.concatenate([p.counts for p in parts]), pa.int64()), pa.array(totals)], schema=out)

    return tables.texts(docs, id_col, text_col).mapInArrow(count, "doc_id bigint, n_pretokens bigint, n_tokens bigint")
