"""Operator 7: word-piece counts by a linear longest-match automaton.

The vocabulary's trie gets failure links and, with each, the number of pieces that following it pops (Song et al.,
Fast WordPiece Tokenization, 2021). Reading a word moves through the trie; where no child fits, the failure link pops
a known number of pieces and the reading goes on from its target, so a word of n characters takes O(n) steps and no
piece is ever built. Words are runs of anything but white space, read with a leading word mark, which only a word's
first piece can hold. A word that no sequence of greedy matches covers counts as one unknown piece.

The counts of words seen lately are kept in a bounded table for each worker. The vocabulary is a file of a public
tokenizer, given by path.

Defined results: null and empty texts have 0 words and 0 pieces. Repeated rows get equal counts. An empty table gives
no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import slices, table, tidy

MARK = "▁"
KEPT_WORDS = 200_000
#: Characters of a word that is worth keeping.
KEPT_LENGTH = 64


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return [model.id_to_piece(i) for i in plain]


class LongestMatch:
    """States are numbers; `child[s]` maps a character to a state. `fail[s]` is -1 where no match can go on."""

    def __init__(self, vocabulary: Iterable[str]):
        self.child: list[dict[str, int]] = [{}]
        final = [False]
        for piece in vocabulary:
            state = 0
            for c in piece:
                nxt = self.child[state].get(c)
                if nxt is None:
                    nxt = self.child[state][c] = len(self.child)
                    self.child.append({})
                    final.append(False)
                state = nxt
            final[state] = state != 0
        self.fail, self.popped = [-1] * len(self.child), [0] * len(self.child)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for c, nxt in self.child[state].items():
                queue.append(nxt)
                if final[nxt]:  # the whole of it is a piece: pop it and start anew
                    self.fail[nxt], self.popped[nxt] = 0, 1
                    continue
                at, pops = self.fail[state], self.popped[state]
                while at != -1 and c not in self.child[at]:
                    pops += self.popped[at]
                    at = self.fail[at]
                if at != -1:
                    self.fail[nxt], self.popped[nxt] = self.child[at][c], pops

    def count(self, word: str) -> int:
        """Pieces of `word`; 1 for one that can't be covered."""
        child, fail, popped = self.child, self.fail, self.popped
        state = pieces = 0
        for c in word:
            while (nxt := child[state].get(c)) is None:
                if fail[state] == -1:
                    return 1
                pieces += popped[state]
                state = fail[state]
            state = nxt
        while state:
            if fail[state] == -1:
                return 1
            pieces += popped[state]
            state = fail[state]
        return pieces


class WordCounts(dict):
    """Counts by word, made when asked for; at most KEPT_WORDS are kept."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(MARK + word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = n
        return n


_known: dict[str, WordCounts] = {}


def word_counts(path: str) -> WordCounts:
    if path not in _known:
        _known[path] = WordCounts(LongestMatch(pieces_of(path)))
    return _known[path]


def count_pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words and n_pieces of every row of `docs` (doc_id, text); `path` is the vocabulary's file, on all machines."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(path)
        for batch in slices(batches):
            words, found = [], []
            for text in batch.column("text").to_pylist():
                parts = text.split() if text else []
                words.append(len(parts))
                found.append(sum(counts[w] for w in parts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "n_words", "n_pieces"])

    packed = docs.select("doc_id", "text")
    schema = packed.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_pieces")).schema
    return packed.mapInArrow(count, schema)


def op7_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of all `documents` over the pieces of piece_bpe_32k.model."""
    return count_pieces(table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"))
