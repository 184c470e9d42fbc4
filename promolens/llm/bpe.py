"""Byte-level BPE encoding and decoding by speculation and verification.

Distinct pre-tokens of a block are first cut greedily into longest vocabulary entries. A cut is the exact BPE result if
every two adjacent tokens are compatible, that is, if no merge that the exact procedure would do earlier reaches
across their border; this is tested for all adjacent pairs at once with arrays. Only words with an incompatible pair
go through exact merging. Results per distinct word are kept in sorted arrays of bounded size.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import BASE, SYMBOLS, U64, blocks, mix, ragged, ranges_hash, sha_slices

KEPT_WORDS = 1 << 20
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"
LETTER, NUMBER, SPACE = 1, 2, 3
# White space of the pre-tokeniser, and the endings that an apostrophe starts.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, inverted.

    Printable Latin-1 characters stand for themselves; the other bytes take the characters from 256 on, in order.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(1)
def _classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            out[cp] = LETTER if kind == "L" else NUMBER
    out[SPACES] = SPACE
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte place and code point of every character of well-formed UTF-8."""
    if not len(data) or data.max() < 0x80:
        return np.arange(len(data)), data.astype(np.int32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    wide = np.r_[data, np.zeros(3, np.uint8)]
    first = data[at].astype(np.int32)
    out = first.copy()
    for size, low, bits in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        some = np.flatnonzero((first >= low) & (first < (0xE0, 0xF0, 0x100)[size - 2]))
        if len(some):
            value = first[some] & bits
            for k in range(1, size):
                value = (value << 6) | (wide[at[some] + k] & 0x3F)
            out[some] = np.minimum(value, 0x10FFFF)
    return at, out


def pre_tokens(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Byte places where pre-tokens start. ``cuts`` are the places that nothing may reach across.

    Letters, numbers, and other characters form runs, which one space may lead; white space before one stays apart;
    an apostrophe that starts a token takes one of the fixed endings.
    """
    at, cp = code_points(data)
    n = len(at)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[cp]
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    fresh = edge[at]
    fresh[0] = True
    ends = np.r_[fresh[1:], True]  # the last character before a cut
    before = np.r_[np.uint8(255), kind[:-1]]
    after = np.r_[kind[1:], np.uint8(255)]
    led = np.r_[False, cp[:-1] == 0x20] & ~fresh
    white = kind == SPACE
    start = fresh | (~white & (before != kind) & ~led) | (white & (before != SPACE))
    start |= white & (before == SPACE) & (after != SPACE) & ~ends
    mark = np.flatnonzero((cp == 0x27) & start & ~ends)
    if len(mark):
        padded = np.r_[cp, 0, 0]
        shut = np.r_[ends, True, True]
        one = np.isin(padded[mark + 1], [ord(c) for c in SHORT_ENDINGS])
        two = np.zeros(len(mark), bool)
        for a, b in LONG_ENDINGS:
            two |= (padded[mark + 1] == ord(a)) & (padded[mark + 2] == ord(b))
        two &= ~shut[mark + 1]
        start[mark[one | two] + 1] = False
        for hits, size in ((mark[one], 2), (mark[two], 3)):
            later = hits + size
            start[later[later < n]] = True
    return at[start]


class Codec:
    """A byte-level BPE vocabulary with its merges, numbered in the order of the merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        names = [*sorted(alphabet, key=alphabet.get), *(a + b for a, b in merges)]
        number = {name: i for i, name in enumerate(names)}
        self.left = np.arange(len(names))
        self.right = np.arange(len(names))
        for i, (a, b) in enumerate(merges, 256):
            self.left[i], self.right[i] = number[a], number[b]
        self.ids = np.array([vocab[n] for n in names], np.int32)
        self.number = {raw(n): i for i, n in enumerate(names)}
        self.reach: dict[bytes, int] = {}  # longest entry by its first two bytes
        for name in self.number:
            self.reach[name[:2]] = max(self.reach.get(name[:2], 1), len(name))
        self.merge = {(a, b): i for i, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())) if i >= 256}
        keys = self.left[256:] << 32 | self.right[256:]
        order = np.argsort(keys)
        self.pair_keys, self.pair_numbers = keys[order], order + 256
        size = max([*vocab.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for name, i in vocab.items():
            pieces[i] = raw(name) if all(c in alphabet for c in name) else name.encode()
        for text, i in self.special.items():
            pieces[i] = text
        self.piece_sizes = np.array([len(p) for p in pieces])
        self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        digits = [b"%d," % i for i in range(size)]
        self.digit_sizes = np.array([len(d) for d in digits])
        self.digit_starts = np.cumsum(self.digit_sizes) - self.digit_sizes
        self.digit_bytes = np.frombuffer(b"".join(digits), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, U64)
        self.known_row = np.zeros(0, np.int32)
        self.row_start = np.zeros(0, np.int64)
        self.row_size = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """For token numbers side by side: is no merge across their border due before the merges that made them?

        Both tokens are taken apart along the border, the later merge first. A pair that could merge at that time,
        before what has been taken apart so far, contradicts the cut.
        """
        ok = np.ones(len(first), bool)
        live = np.arange(len(first))
        a, b = first.copy(), second.copy()
        limit = np.full(len(first), 1 << 40)
        while len(live):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            clash = (self.pair_keys[at] == key) & (self.pair_numbers[at] < limit)
            ok[live[clash]] = False
            left_turn = a > b  # equal numbers: the right one is taken apart first
            stop = clash.copy()
            # The token made last is undone; bytes cannot be, and what is left of the other side is tried then.
            whole_a, whole_b = self.right[a] == a, self.right[b] == b
            undo_a = np.where(left_turn, ~whole_a, whole_b & ~whole_a)
            undo_b = ~undo_a & ~whole_b
            stop |= whole_a & whole_b
            limit = np.where(undo_a, a, np.where(undo_b, b + 1, limit))
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            go = ~stop
            live, a, b, limit = live[go], a[go], b[go], limit[go]
        return ok

    def greedy(self, word: bytes) -> list[int]:
        out, at, n, number, reach = [], 0, len(word), self.number, self.reach
        while at < n:
            end = min(n, at + reach.get(word[at : at + 2], 1))
            while (t := number.get(word[at:end])) is None:
                end -= 1
            out.append(t)
            at = end
        return out

    def exact(self, word: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        merge, none = self.merge, 1 << 40
        parts = list(word)
        if len(parts) <= 64:
            get = merge.get
            due = [get(p, none) for p in zip(parts, parts[1:])]
            while due and (m := min(due)) < none:
                i = due.index(m)
                parts[i] = m
                del parts[i + 1], due[i]
                if i:
                    due[i - 1] = get((parts[i - 1], m), none)
                if i < len(due):
                    due[i] = get((m, parts[i + 1]), none)
            return parts
        n = len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m, i, p) for i, p in enumerate(zip(parts, parts[1:])) if (m := merge.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, p = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] < 0 or (parts[i], parts[j]) != p:
                continue
            parts[i], parts[j] = m, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := merge.get(p := (parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (m, x, p))
        return [p for p in parts if p >= 0]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of distinct words and their counts by word: speculate, verify, and merge what failed."""
        cut = [self.greedy(w) for w in words]
        counts = np.array([len(c) for c in cut])
        flat = np.fromiter((t for c in cut for t in c), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, back = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        fine = self.compatible(keys >> 32, keys & 0xFFFFFFFF)[back]
        failed = np.unique(owner[inner[~fine]]).tolist()
        if failed:
            for i in failed:
                cut[i] = self.exact(words[i])
            counts = np.array([len(c) for c in cut])
            flat = np.fromiter((t for c in cut for t in c), np.int64, int(counts.sum()))
        return flat, counts

    def encode(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block and their cuts by text. Strings of special tokens become those tokens."""
        apart, special = [], []
        raw = data.tobytes() if self.special else b""
        for text, i in self.special.items():
            at = raw.find(text)
            while at >= 0:
                row = int(np.searchsorted(cuts, at, "right"))
                if at + len(text) <= cuts[row]:
                    apart += [at, at + len(text)]
                    special.append((at, i))
                    at = raw.find(text, at + len(text))
                else:
                    at = raw.find(text, at + 1)
        walls = np.unique(np.r_[cuts, apart].astype(np.int64)) if apart else cuts
        starts = pre_tokens(data, walls)
        if special:
            inside = np.searchsorted(np.sort([a for a, _ in special]), starts, "right")
            firsts = np.sort([a for a, _ in special])
            sizes = dict((a, len(self.piece(i))) for a, i in special)
            into = np.r_[-1, firsts][inside]
            reach = np.r_[0, [sizes[a] for a in firsts.tolist()]][inside]
            starts = starts[~((into >= 0) & (starts > into) & (starts < into + reach))]
        ends = np.r_[starts[1:], len(data)]
        hashes = mix(ranges_hash(SYMBOLS[data], starts, ends, BASE) + (ends - starts).astype(U64) * SYMBOLS[0])
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > KEPT_WORDS:
            self._forget()
        at = np.searchsorted(self.known, unique)
        held = np.zeros(len(unique), bool)
        inside = at < len(self.known)
        held[inside] = self.known[at[inside]] == unique[inside]
        row = np.zeros(len(unique), np.int64)
        row[held] = self.known_row[at[held]]
        new = np.flatnonzero(~held)
        if len(new):
            view = data.tobytes() if not raw else raw
            flat, counts = self.words([view[starts[i] : ends[i]] for i in first[new].tolist()])
            row[new] = len(self.row_size) + np.arange(len(new))
            self.row_start = np.r_[self.row_start, len(self.flat) + np.cumsum(counts) - counts]
            self.row_size = np.r_[self.row_size, counts.astype(np.int32)]
            self.flat = np.r_[self.flat, self.ids[flat]]
            places = np.searchsorted(self.known, unique[new])
            self.known = np.insert(self.known, places, unique[new])
            self.known_row = np.insert(self.known_row, places, row[new])
        rows = row[back]
        sizes = self.row_size[rows]
        for a, _ in special:
            sizes[np.searchsorted(starts, a)] = 1
        ids = self.flat[np.minimum(ragged(self.row_start[rows], sizes), max(len(self.flat) - 1, 0))]
        place = np.r_[0, np.cumsum(sizes)]
        for a, i in special:
            ids[place[np.searchsorted(starts, a)]] = i
        return ids, place[np.searchsorted(starts, cuts)]

    def piece(self, i: int) -> bytes:
        a = self.piece_starts[i]
        return self.piece_bytes[a : a + self.piece_sizes[i]].tobytes()

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts of a block and their cuts by text."""
        sizes = self.piece_sizes[ids]
        return self.piece_bytes[ragged(self.piece_starts[ids], sizes)], np.r_[0, np.cumsum(sizes)][cuts]

    def decimals(self, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decimal ids, a comma after each, and their cuts by text."""
        sizes = self.digit_sizes[ids]
        return self.digit_bytes[ragged(self.digit_starts[ids], sizes)], np.r_[0, np.cumsum(sizes)][cuts]


@lru_cache(2)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, read once per worker."""
    return Codec(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_codes(docs: DataFrame, path: str | None = None, outputs: bool = True) -> DataFrame:
    """Encode every text and decode the ids again.

    Returns per input row doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 and, with
    ``outputs``, the ids and the decoded text. A null text counts as empty: no ids, hashes of the empty string; a null
    doc_id stays null. The file at ``path`` must be there for every executor. Other columns are not read.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for part in blocks(batches, limit=2 << 20):
            ids, cuts = code.encode(part.data, part.cuts)
            text, text_cuts = code.decode(ids, cuts)
            digits, digit_cuts = code.decimals(ids, cuts)
            view = [slice(a, max(a, b - 1)) for a, b in zip(digit_cuts[:-1].tolist(), digit_cuts[1:].tolist())]
            listed = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids)) if outputs else pa.nulls(len(part), pa.list_(pa.int32()))
            decoded = [text[a:b].tobytes().decode("utf-8", "replace") if outputs else None for a, b in zip(text_cuts[:-1].tolist(), text_cuts[1:].tolist())]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(cuts)),
                    pa.array([_sha(digits[s]) for s in view]),
                    pa.array(sha_slices(text, text_cuts)),
                    listed,
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"],
            )

    out = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, RESULT)
    return out if outputs else out.drop("ids", "decoded")


def _sha(data: np.ndarray) -> str:
    return sha_slices(data, np.array([0, len(data)]))[0]


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codes(spark.read.parquet(f"{sf_dir}/documents.parquet"), outputs=False)
