"""Operator 8: SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text gets the word mark for each space and one in front, and is cut into words where a mark follows anything else:
no piece spans such a place (checked when the model is read), so words merge independently. Words of more than CUT_FROM
characters are also cut between two characters that no piece holds side by side, seen through windows of three. The parts
that a task hasn't met lately are encoded together: one flat array of symbols, the rank of each adjacent pair, the least
rank of each part by a segmented minimum, the leftmost pairs of that rank merged in all parts at once; then the array is
compacted, finished parts leave, and the next round follows until no pair remains.

In parts of up to SEVERAL_FROM characters a round merges one pair. In longer ones it merges every pair of the least rank
that the library would merge next: from left to right, up to the first whose merge brings up a pair of the same or a
better rank, which the library's queue would take before the rest. Characters without a piece become bytes.

Decoding joins the pieces, turns runs of byte pieces into text (bad bytes into U+FFFD) and marks into spaces, and drops
the space in front.

Defined results: null and empty texts have no ids and decode to the empty text. Repeated rows get equal results. An
empty table gives no rows. The model's file is given by path and must be a BPE model without normalisation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import table, tidy
from .token_counts import MARK, public_path

#: Characters of a word that is cut where no piece goes on, and of a part whose rounds merge several pairs.
CUT_FROM, SEVERAL_FROM = 48, 48
#: Words, and characters of them, that a task keeps from batch to batch.
KEPT_WORDS = 60_000
KEPT_CHARACTERS = 1 << 22
#: Characters that are encoded in one flat array.
FLAT = 1 << 18
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Model:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.special = {i for i in range(n) if model.is_control(i)}
        self.bytes_of = {i: int(self.pieces[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.bytes_of.items()}
        self.lowest_byte, self.highest_byte = min(self.bytes_of, default=0), max(self.bytes_of, default=0)
        self.unknown = model.unk_id()
        other = self.special | set(self.bytes_of) | {self.unknown}
        if len(self.byte_id) != 256 or any(model.is_unused(i) for i in range(n)) or model.normalize("Ａ  a ") != f"{MARK}Ａ{MARK}{MARK}a{MARK}":
            raise ValueError("a BPE model with byte fallback, without unused pieces and normalisation is needed")
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in other}
        scores = {i: model.get_score(i) for i in self.id_of.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {i: order[s] for i, s in scores.items()}
        if any(a != MARK and b == MARK for p in self.id_of for a, b in zip(p, p[1:], strict=False)):
            raise ValueError("a piece spans two words")
        points = [np.array([ord(c) for c in p], dtype=np.int64) for p in self.id_of]
        self.twos = np.unique(np.array([p[0] << 21 | p[1] for p in points if len(p) == 2], dtype=np.int64))
        self.threes = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(p[:-2] << 42 | p[1:-1] << 21 | p[2:] for p in points if len(p) > 2)]))
        # Symbols: ids of pieces, then numbers for characters without a piece, which never merge.
        pairs = [(self.id_of[p[:i]], self.id_of[p[i:]], self.id_of[p]) for p in self.id_of for i in range(1, len(p)) if p[:i] in self.id_of and p[i:] in self.id_of]
        left, right, whole = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
        keys = left * n + right
        by_key = np.argsort(keys)
        self.n, self.keys, self.wholes = n, keys[by_key], whole[by_key]
        self.ranks = np.array([self.rank.get(i, 0) for i in range(n)], dtype=np.int64)
        self.symbol_of = np.arange(n, n + 0x110000, dtype=np.int64)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.as_text = [str(i) for i in range(n)]
        self.as_words = [p.replace(MARK, " ") for p in self.pieces]

    def symbols(self, text: str) -> np.ndarray:
        """Of each character its piece's id, or n plus its code point if it has none."""
        return self.symbol_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]

    def wholes_of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """What the symbols `one` and `two` merge into; -1 where they don't."""
        key = np.where((one < self.n) & (two < self.n), one * self.n + two, -1)
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.wholes[place], -1)

    def merge_of(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each place in `at` what its symbol and the next merge into; -1 where they don't."""
        at = np.minimum(at, len(symbols) - 2)
        return np.where(owner[at] == owner[at + 1], self.wholes_of(symbols[at], symbols[at + 1]), -1)

    def rank_of(self, whole: np.ndarray) -> np.ndarray:
        return np.where(whole >= 0, self.ranks[whole], len(self.pieces))

    def chosen(self, symbols: np.ndarray, owner: np.ndarray, whole: np.ndarray, rank: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The places that the library merges next, one after the other, while the least rank of their part stays; `least`
        has it for each symbol."""
        at = np.flatnonzero((rank == least) & (rank < len(self.pieces)))
        run = np.concatenate([[True], at[1:] != at[:-1] + 1])
        inside = np.arange(len(at))
        at = at[(inside - np.maximum.accumulate(np.where(run, inside, 0))) % 2 == 0]  # a merge takes the next place's symbol
        new, last = whole[at], len(symbols) - 1
        before = np.maximum(at - 1, 0)
        left = symbols[before]
        touching = np.flatnonzero((at[1:] == at[:-1] + 2) & (owner[at[1:]] == owner[at[:-1]])) + 1
        left[touching] = new[touching - 1]
        behind = np.minimum(at + 2, last)
        left_whole = np.where((at > 0) & (owner[before] == owner[at]), self.wholes_of(left, new), -1)
        right_whole = np.where((at + 2 <= last) & (owner[behind] == owner[at]), self.wholes_of(new, symbols[behind]), -1)
        ends = (np.minimum(self.rank_of(left_whole), self.rank_of(right_whole)) <= rank[at]).astype(np.int64)
        earlier = np.cumsum(ends) - ends
        first = np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])
        return at[earlier == earlier[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]]

    def flat_merge(self, symbols: np.ndarray, lengths: np.ndarray, several: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all parts after all merges, and how many each part has."""
        parts, never = len(lengths), np.int64(len(self.pieces))
        owner = np.repeat(np.arange(parts), lengths)
        whole = np.append(self.merge_of(symbols, owner, np.arange(len(symbols) - 1)), -1) if len(symbols) > 1 else np.full(len(symbols), -1)
        rank = self.rank_of(whole)
        out_symbols, out_owner = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(starts, len(symbols)))
            if several:
                least = np.minimum.reduceat(rank, starts)
                active, first = least < never, self.chosen(symbols, owner, whole, rank, np.repeat(least, sizes))
            else:
                # Rank first, then place: the least value of a part is its leftmost pair of least rank.
                first = np.minimum.reduceat(rank * len(symbols) + np.arange(len(symbols)), starts) % len(symbols)
                active = rank[first] < never
                first = first[active]
            going = np.repeat(active, sizes)
            if not active.all():
                out_symbols.append(symbols[~going])
                out_owner.append(owner[~going])
            symbols[first] = whole[first]
            going[first + 1] = False
            now = np.cumsum(going)[first] - 1
            symbols, owner, whole, rank = symbols[going], owner[going], whole[going], rank[going]
            if len(symbols) < 2:
                whole[:], rank[:] = -1, never
                continue
            again = np.concatenate([now, now[now > 0] - 1])
            again = again[again < len(symbols) - 1]
            whole[again] = self.merge_of(symbols, owner, again)
            whole[-1] = -1
            rank[again] = self.rank_of(whole[again])
            rank[-1] = never
        out_symbols, out_owner = np.concatenate([symbols, *out_symbols]), np.concatenate([owner, *out_owner])
        return out_symbols[np.argsort(out_owner, kind="stable")], np.bincount(out_owner, minlength=parts)

    def parts(self, word: str) -> list[str]:
        """`word`, cut where no piece goes on if it is long."""
        if len(word) <= CUT_FROM:
            return [word]
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        held = found_in(points[:-1] << 21 | points[1:], self.twos)  # between a character and the next
        three = found_in(points[:-2] << 42 | points[1:-1] << 21 | points[2:], self.threes)
        held[:-1] |= three
        held[1:] |= three
        cuts = [0, *(np.flatnonzero(~held) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def ids(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if s < self.n:
                out.append(s)
            else:
                out += [self.byte_id[b] for b in chr(s - self.n).encode("utf-8", "replace")]
        return out

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, int, str, str]]:
        """Each word with its number of ids, its ids as text and its text."""
        cut = {w: self.parts(w) for w in words if len(w) > CUT_FROM}
        inner = {p for parts in cut.values() for p in parts if len(parts) > 1}.difference(words)
        whole = [w for w in words if len(cut.get(w, "1")) == 1] + sorted(inner)
        known = {}
        for several in (False, True):
            some = [p for p in whole if (len(p) > SEVERAL_FROM) == several]
            for a, b in batches_of([len(p) for p in some], FLAT):
                for part in self.encode_parts(some[a:b], several):
                    if part[0] not in inner:
                        yield part
                    if cut:
                        known[part[0]] = part[1:]
        for w, parts in cut.items():
            if len(parts) > 1:
                found = [known[p] for p in parts]
                yield w, sum(n for n, _, _ in found), ",".join(ids for _, ids, _ in found), "".join(shown for _, _, shown in found)

    def encode_parts(self, parts: list[str], several: bool) -> Iterator[tuple[str, int, str, str]]:
        symbols, counts = self.flat_merge(self.symbols("".join(parts)), np.array([len(p) for p in parts]), several)
        ends = np.cumsum(counts)
        odd = set(np.searchsorted(ends, np.flatnonzero((symbols >= self.n) | (symbols >= self.lowest_byte) & (symbols <= self.highest_byte)), side="right").tolist())
        listed = symbols.tolist()
        texts, shown = ([x[i] if i < self.n else "" for i in listed] for x in (self.as_text, self.as_words))
        start = 0
        for k, (part, end) in enumerate(zip(parts, ends.tolist(), strict=True)):
            if k in odd:
                yield self.told(part, self.ids(listed[start:end]))
            else:
                yield part, end - start, ",".join(texts[start:end]), "".join(shown[start:end])
            start = end

    def told(self, word: str, ids: list[int]) -> tuple[str, int, str, str]:
        return word, len(ids), ",".join([self.as_text[i] for i in ids]), self.decode(ids)

    def decode(self, ids: list[int]) -> str:
        """The text of `ids`, with the space in front."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes_of:
                held.append(self.bytes_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.special:
                out.append(self.pieces[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")


def found_in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which `keys` the sorted `known` holds."""
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), dtype=bool)


def batches_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes add up to about `most`."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class Encoder:
    """Words with their number of ids, ids as text and text. Those met lately are kept: when `known` is full it becomes
    `older`, and what is then met again moves back."""

    def __init__(self, model: Model):
        self.model, self.known, self.older, self.held = model, {}, {}, 0

    def words(self, text: str) -> list[str]:
        return WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, words: set[str]) -> dict[str, tuple[int, str, str]]:
        """word -> (number of ids, ids as text, text), for `words` at least."""
        if len(self.known) > KEPT_WORDS or self.held > KEPT_CHARACTERS:
            self.known, self.older, self.held = {}, self.known, 0
        new = []
        for w in words.difference(self.known):
            found = self.older.get(w)
            if found is None:
                new.append(w)
            else:
                self.known[w] = found
            self.held += len(w)
        for w, n, ids, shown in self.model.encode_words(new):
            self.known[w] = (n, ids, shown)
        return self.known

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        known = self.learn(set(words))
        return [int(i) for w in words for i in known[w][1].split(",")]

    def decode(self, ids: list[int]) -> str:
        """The text of `ids` without the space in front."""
        out = self.model.decode(ids)
        return out[1:] if out.startswith(" ") else out


_models: dict[str, Model] = {}


def encoder(path: str) -> Encoder:
    """An encoder that has met no words yet; a worker reads each model once, and drops a task's words with the task."""
    if path not in _models:
        _models[path] = Model(path)
    return Encoder(_models[path])


def encode_texts(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """`docs` (text and any other columns) in a struct `row`, with n_tokens, ids_sha256, decoded_sha256, and ids if asked for."""
    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    fields = [packed.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for whole in batches:
            lengths = [n or 0 for n in pa.compute.utf8_length(whole.column("text")).to_pylist()]
            for a, b in batches_of(lengths, 1 << 19):
                batch = whole.slice(a, b - a)
                texts = [e.words(t or "") for t in batch.column("text").to_pylist()]
                known = e.learn({w for words in texts for w in words})
                n, ids, decoded, full = [], [], [], []
                for words in texts:
                    found = [known[w] for w in words]
                    n.append(sum([x[0] for x in found]))
                    ids.append(digest(",".join([x[1] for x in found])))
                    # Byte pieces of one character never span words, so words decode one by one.
                    decoded.append(digest("".join([x[2] for x in found])[1:]))
                    if with_ids:
                        full.append(np.fromstring(",".join([x[1] for x in found]), dtype=np.int32, sep=",") if found else [])
                out = [batch.column("row"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                out += [pa.array(full, pa.list_(pa.int32()))] * with_ids
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in schema])

    return packed.mapInArrow(encode, schema)


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all `documents`, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_texts(docs, public_path("piece_bpe_32k.model"), with_ids=False)
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
