"""Byte-level BPE as a streaming transducer with bounded lookahead, and decoding by an incremental byte-to-text machine.

Text is cut into pre-tokens, at whose ends every state is stable. For each byte position the transducer keeps the last
token of the encoding of everything up to it. That token is unique: it ends there and stands beside its predecessor
unchanged when the two are merged alone. A later position's predecessor lies at most ``lookahead`` bytes back, the
longest token that the merge list can make, so what precedes the common ancestor of the last ``lookahead`` positions is
stable and is emitted; memory holds one window, however long the text is.

It runs in two forms. ``Merges.transduce`` advances the unknown pre-tokens of a group of texts (``GROUP`` characters) side
by side, a byte of each per step, and a cache of bounded size remembers their ids. A pre-token longer than the lookahead
goes through ``StreamEncoder``, which emits while it reads.

Defined results: null text is the empty text (no tokens); the tokenizer's special strings become their own ids.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The letters and the numbers that Unicode 16.0, which the tokenizer's classes follow, adds to 15.1.
LETTERS_16 = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
# Fixed value: white space by Unicode's property.
SPACES = r"\t-\r \x85\xa0  -     　"
BLOCK, GROUP = 1 << 16, 1 << 19
CACHE = 150_000
#: Words that go together fill at most this many cells of a matrix, or one row.
CELLS = 1 << 17
#: Pairs of tokens whose standing together is remembered, in a table of this many places.
PAIRS = 1 << 20


def class_of(kind: str, added: tuple, top: int) -> str:
    """The code points up to ``top`` of a major category, as the inside of a character class."""
    if unicodedata.unidata_version[:4] not in ("15.1", "16.0"):
        raise RuntimeError(f"character classes need Unicode 15.1 or 16.0, not {unicodedata.unidata_version}")
    inside = np.fromiter((unicodedata.category(chr(c))[0] == kind for c in range(top + 1)), bool, top + 1)
    for lo, hi in added:
        inside[lo : hi + 1] = True
    turns = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
    return "".join(f"\\U{lo:08x}-\\U{hi - 1:08x}" for lo, hi in turns.tolist())


def pattern(letters: str, numbers: str, spaces: str) -> str:
    # Fixed value: the public pattern that byte-level BPE of this kind splits text with.
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"


class PreTokens:
    """Cuts text into pre-tokens: ASCII text, text of the basic plane and all other text by patterns of their own, which cut alike and differ in speed."""

    def __init__(self):
        self.ascii = re.compile(pattern("A-Za-z", "0-9", r"\t-\r ")).findall
        self.basic = re.compile(pattern(class_of("L", LETTERS_16, 0xFFFF), class_of("N", NUMBERS_16, 0xFFFF), SPACES)).findall
        self.beyond, self._any = re.compile("[\U00010000-\U0010ffff]").search, None

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        if not self.beyond(text):
            return self.basic(text)
        if self._any is None:
            self._any = re.compile(pattern(class_of("L", LETTERS_16, 0x10FFFF), class_of("N", NUMBERS_16, 0x10FFFF), SPACES)).findall
        return self._any(text)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable Latin-1 for itself, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Merges:
    """The merge list: single-byte ids, each pair's rank, the id that each rank makes, and each id's bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in s) for s, i in vocab.items() if all(c in letters for c in s)}
        self.byte_id = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.pair: dict[tuple[int, int], int] = {}
        self.makes: list[int] = []
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pair[vocab[a], vocab[b]] = rank
            self.makes.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        made = set(self.makes) | set(self.byte_id)
        #: The sufficient lookahead in bytes: no token that merging can make is longer.
        self.lookahead = max(len(self.bytes_of[i]) for i in made)
        self.made = made
        self._together: dict[tuple[int, int], bool] = {}
        # the pairs as sorted numbers, for looking up many at once; ``blank`` is beside every word and pairs with nothing
        self.blank = max(self.bytes_of) + 1
        pairs = np.array([a * (self.blank + 1) + b for a, b in self.pair], np.int64)
        order = np.argsort(pairs)
        self.sorted_pairs, self.sorted_ranks = pairs[order], np.arange(len(pairs))[order].astype(np.int32)
        self.makes_of, self.id_of_byte = np.array(self.makes, np.int32), np.array(self.byte_id, np.int32)
        self.names = np.array([str(i) for i in range(self.blank)], object)
        self.pieces = np.array([self.bytes_of.get(i, b"") for i in range(self.blank)], object)
        self.size_of = np.array([len(x) for x in self.pieces], np.int32)
        # a trie of the tokens: sorted (state, byte) numbers, where each leads, and the token that ends in a state or -1
        edges: dict[int, int] = {}
        token = [-1]
        for i in sorted(made):
            at = 0
            for byte in self.bytes_of[i]:
                to = edges.get(at << 8 | byte)
                if to is None:
                    to = edges[at << 8 | byte] = len(token)
                    token.append(-1)
                at = to
            token[at] = i
        steps, leads = np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges))
        order = np.argsort(steps)
        self.steps, self.leads, self.token = steps[order], leads[order], np.array(token, np.int32)
        self.pair_key, self.pair_ok = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each ``b`` may stand after its ``a``, or at the start of a pre-token where ``a`` is the blank."""
        key = a.astype(np.int64) * (self.blank + 1) + b
        place = lambda k: ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % PAIRS
        at = place(key)
        out, new = self.pair_ok[at], self.pair_key[at] != key
        if new.any():
            fresh, of = np.unique(key[new], return_inverse=True)
            first, second = fresh // (self.blank + 1), fresh % (self.blank + 1)
            alone = first == self.blank
            first[alone] = 0
            got = self.merge_many([y if z else x + y for x, y, z in zip(self.pieces[first], self.pieces[second], alone, strict=True)])
            pair = np.stack([first, second], 1).astype(np.int32)
            want = [p[4:] if z else p for p, z in zip(map(bytes, pair), alone, strict=True)]
            ok = np.fromiter((g == w for g, w in zip(got, want, strict=True)), bool, len(fresh))
            out[new] = ok[of]
            self.pair_key[place(fresh)], self.pair_ok[place(fresh)] = fresh, ok
        return out

    def transduce(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, four bytes each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order, out, lo = np.argsort(sizes, kind="stable"), [b""] * len(words), 0
        by_size = sizes[order]
        while lo < len(words):
            widest = int(by_size[lo]) * 5 // 4 + 1
            hi = min(lo + max(1, CELLS // (widest + 2)), int(np.searchsorted(by_size, widest, "right")))
            chosen = order[lo:hi].tolist()
            ids, counts = self._transduce_rows([words[i] for i in chosen], by_size[lo:hi])
            raw, start = ids.tobytes(), 0
            for i, end in zip(chosen, np.cumsum(4 * counts).tolist(), strict=True):
                out[i] = raw[start:end]
                start = end
            lo = hi
        return out

    def _transduce_rows(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has. Words come by size; (row, start, state) are the stretches that some token begins with."""
        n, width = len(words), int(sizes[-1])
        data = np.zeros((n, width), np.uint8)
        data[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        last = np.full((n, width + 1), -1, np.int32)
        last[:, 0] = self.blank
        row, start, state = (np.zeros(0, np.int64) for _ in range(3))
        for i in range(width):
            lo = int(np.searchsorted(sizes, i, "right"))
            on = row >= lo
            row = np.concatenate([row[on], np.arange(lo, n)])
            start, state = np.concatenate([start[on], np.full(n - lo, i)]), np.concatenate([state[on], np.zeros(n - lo, np.int64)])
            step = state << 8 | data[row, i]
            at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            on = self.steps[at] == step
            row, start, state = row[on], start[on], self.leads[at[on]].astype(np.int64)
            token = self.token[state]
            ends = np.flatnonzero(token >= 0)
            ends = ends[self.follows(last[row[ends], start[ends]], token[ends])]
            last[row[ends], i + 1] = token[ends]
        # back from each end, token by token
        left, rows, found = sizes.copy(), np.arange(n), []
        counts = np.zeros(n, np.int64)
        while len(rows := rows[left[rows] > 0]):
            token = last[rows, left[rows]]
            found.append((rows, token))
            left[rows] -= self.size_of[token]
            counts[rows] += 1
        ids, behind = np.zeros(int(counts.sum()), np.int32), np.cumsum(counts)
        for k, (rows, token) in enumerate(found):
            ids[behind[rows] - 1 - k] = token
        return ids, counts

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; the number of merges where there is none."""
        key = a.astype(np.int64) * (self.blank + 1) + b
        at = np.minimum(np.searchsorted(self.sorted_pairs, key), len(self.sorted_pairs) - 1)
        return np.where(self.sorted_pairs[at] == key, self.sorted_ranks[at], np.int32(len(self.makes)))

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, four bytes each: every round does the next merge of all words that have one."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order, out, lo = np.argsort(sizes, kind="stable"), [b""] * len(words), 0
        by_size = sizes[order]
        while lo < len(words):
            widest = int(by_size[lo]) * 5 // 4 + 1
            hi = min(lo + max(1, CELLS // (widest + 2)), int(np.searchsorted(by_size, widest, "right")))
            chosen = order[lo:hi].tolist()
            ids, counts = self._merge_rows([words[i] for i in chosen], by_size[lo:hi])
            raw, start = ids.tobytes(), 0
            for i, end in zip(chosen, np.cumsum(4 * counts).tolist(), strict=True):
                out[i] = raw[start:end]
                start = end
            lo = hi
        return out

    def _merge_rows(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has. A row is a word between blanks."""
        n, width, none = len(words), int(sizes[-1]) + 2, len(self.makes)
        spot = np.arange(width)
        alive = (spot > 0) & (spot <= sizes[:, None])
        ids = np.full((n, width), self.blank, np.int32)
        ids[alive] = self.id_of_byte[np.frombuffer(b"".join(words), np.uint8)]
        rank = np.full((n, width), none, np.int32)
        rank[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        cells = np.arange(n * width)
        after, before = cells + 1, cells - 1
        flat_ids, flat_rank, flat_alive = ids.reshape(-1), rank.reshape(-1), alive.reshape(-1)
        rows = np.arange(n)
        while len(rows):
            here = rank[rows]
            at = here.argmin(1)
            best = here[np.arange(len(rows)), at]
            more = best < none
            rows, left, best = rows[more], (rows * width + at)[more], best[more]
            gone = after[left]
            right, prior = after[gone], before[left]
            flat_ids[left] = self.makes_of[best]
            flat_alive[gone], flat_rank[gone] = False, none
            after[left], before[right] = right, left
            made = flat_ids[left]
            flat_rank[left], flat_rank[prior] = self.ranks(made, flat_ids[right]), self.ranks(flat_ids[prior], made)
        return ids[alive], alive.sum(1)

    def merge(self, data: bytes) -> list[int]:
        """The ids of a short byte string: lowest rank first, from the left."""
        ids, get, none = [self.byte_id[b] for b in data], self.pair.get, len(self.makes)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at : at + 2] = [self.makes[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), none)
        return ids

    def together(self, a: int | None, b: int) -> bool:
        """Whether ``b`` may follow ``a`` (None: may start a pre-token)."""
        key = (-1 if a is None else a, b)
        got = self._together.get(key)
        if got is None:
            if len(self._together) >= CACHE:
                self._together.clear()
            want = [b] if a is None else [a, b]
            got = self._together[key] = self.merge(b"".join(self.bytes_of[i] for i in want)) == want
        return got

    @property
    def ends(self) -> tuple[dict[bytes, int], set[bytes]]:
        """Tokens by their bytes, and all endings of tokens; made on first use."""
        if not hasattr(self, "_ends"):
            tokens = {self.bytes_of[i]: i for i in self.made}
            self._ends = tokens, {t[k:] for t in tokens for k in range(len(t))}
        return self._ends


class StreamEncoder:
    """Feeds on the bytes of one pre-token piece by piece and gives ids as soon as they are stable."""

    def __init__(self, merges: Merges):
        self.m, self.buf, self.last, self.before = merges, bytearray(), [None], None

    def feed(self, data: bytes) -> list[int]:
        tokens, ends = self.m.ends
        out: list[int] = []
        for b in data:
            self.buf.append(b)
            n, found = len(self.buf), None
            for size in range(1, min(n, self.m.lookahead) + 1):
                piece = bytes(self.buf[n - size :])
                if piece not in ends:
                    break
                t = tokens.get(piece)
                if t is not None and (size == n or self.last[n - size] is not None):
                    prior = self.before if size == n else self.last[n - size]
                    if self.m.together(prior, t):
                        found = t
                        break
            self.last.append(found)
            if n >= 4 * self.m.lookahead:
                out += self._settle()
        return out

    def _back(self, at: int) -> int:
        return at - len(self.m.bytes_of[self.last[at]])

    def _path(self, at: int) -> list[int]:
        ids = []
        while at:
            ids.append(self.last[at])
            at = self._back(at)
        return ids[::-1]

    def _settle(self) -> list[int]:
        n = len(self.buf)
        live = {-p for p in range(max(0, n - self.m.lookahead + 1), n + 1) if p == 0 or self.last[p] is not None}
        heap = list(live)
        heapq.heapify(heap)
        while len(heap) > 1:
            p = -heapq.heappop(heap)
            q = -self._back(p)
            if q not in live:
                live.add(q)
                heapq.heappush(heap, q)
        root = -heap[0]
        ids = self._path(root)
        if ids:
            self.before = ids[-1]
            del self.buf[:root]
            self.last[: root + 1] = [None]
        return ids

    def end(self) -> list[int]:
        ids = self._path(len(self.buf))
        self.__init__(self.m)
        return ids


class Encoder:
    def __init__(self, path: str):
        self.m = Merges(path)
        self.find = PreTokens()
        self.gap = regex.compile(r"(?<=\S) (?=\S)")
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.m.special, key=len, reverse=True)) + ")") if self.m.special else None
        # words known, with their ids as bytes: plain strings, which weigh little and which the garbage collector passes over
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _know(self, words: set[str]) -> dict[str, bytes]:
        """A table that has every one of the words."""
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        words = words - self.new.keys()
        seen = words & self.old.keys()
        self.new.update((w, self.old[w]) for w in seen)
        fresh = list(words - seen)
        self.new.update(zip(fresh, self.m.transduce([w.encode("utf-8", "replace") for w in fresh]), strict=True))
        return self.new

    def _stream(self, word: str):
        machine = StreamEncoder(self.m)
        for at in range(0, len(word), 4096):
            yield np.array(machine.feed(word[at : at + 4096].encode("utf-8", "replace")), np.int32)
        yield np.array(machine.end(), np.int32)

    def _pieces(self, text: str):
        """(text, id): stretches of ordinary text, each cut where a pre-token surely ends, and special tokens."""
        parts = self.special.split(text) if self.special else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield part, self.m.special[part]
                continue
            at = 0
            while at < len(part):
                cut = self.gap.search(part, at + BLOCK) if len(part) - at > BLOCK else None
                end = cut.start() if cut else len(part)
                yield part[at:end], None
                at = end

    def blocks(self, texts):
        """(number of the text, ids), in order: arrays of at most a block of the text each. A text without tokens has none."""
        held, size = [], 0
        for k, text in enumerate(texts):
            for piece, special in self._pieces(text or ""):
                held.append((k, self.find(piece) if special is None else special))
                size += len(piece) + 1
                if size >= GROUP:
                    yield from self._merged(held)
                    held, size = [], 0
        yield from self._merged(held)

    def _merged(self, held):
        longest = self.m.lookahead
        words = set().union(*(w for _, w in held if isinstance(w, list)))
        long = {w for w in words if len(w) > longest}
        get = self._know(words - long if long else words).__getitem__
        for k, found in held:
            if not isinstance(found, list):
                yield k, np.array([found], np.int32)
                continue
            start = 0
            for at in [i for i, w in enumerate(found) if w in long] if long else ():
                yield k, np.frombuffer(b"".join(map(get, found[start:at])), np.int32)
                for ids in self._stream(found[at]):
                    yield k, ids
                start = at + 1
            yield k, np.frombuffer(b"".join(map(get, found[start:] if start else found)), np.int32)

    def encode(self, text: str | None) -> list[int]:
        return [i for _, ids in self.blocks([text]) for i in ids.tolist()]

    def count(self, text: str | None) -> int:
        return self.counts([text])[0]

    def counts(self, texts) -> list[int]:
        """The number of tokens of each text."""
        out: list[int] = []

        def counted():
            for t in texts:
                out.append(0)
                yield t

        for k, block in self.blocks(counted()):
            out[k] += len(block)
        return out


class Decoder:
    """Ids in, text out: bytes pass through a UTF-8 state machine that holds back an unfinished character."""

    def __init__(self, merges: Merges):
        self.pieces = merges.pieces
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.machine.decode(b"".join(self.pieces[np.asarray(ids, np.int32)].tolist()))

    def end(self) -> str:
        return self.machine.decode(b"", True)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process and vocabulary file."""
    return Encoder(path)


class Digest:
    """Number of tokens, SHA-256 of the ids, SHA-256 of the text decoded from them; a block at a time."""

    def __init__(self, m: Merges):
        self.n, self.ids_sha, self.text_sha, self.names, self.decoder = 0, hashlib.sha256(), hashlib.sha256(), m.names, Decoder(m)

    def add(self, ids: np.ndarray) -> None:
        if not len(ids):
            return
        self.ids_sha.update((("," if self.n else "") + ",".join(self.names[ids].tolist())).encode())
        self.n += len(ids)
        self.text_sha.update(self.decoder.feed(ids).encode("utf-8"))

    def end(self) -> tuple[int, str, str]:
        self.text_sha.update(self.decoder.end().encode("utf-8"))
        return self.n, self.ids_sha.hexdigest(), self.text_sha.hexdigest()


def digests(enc: Encoder, texts) -> list[tuple[int, str, str]]:
    """Each text's digest, in order."""
    out, now = [], Digest(enc.m)
    total = 0

    def counted():
        nonlocal total
        for t in texts:
            total += 1
            yield t

    for k, block in enc.blocks(counted()):
        while len(out) < k:
            out.append(now.end())
            now = Digest(enc.m)
        now.add(block)
    while len(out) < total:
        out.append(now.end())
        now = Digest(enc.m)
    return out


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        enc = encoder(path)
        for b in batches:
            got = digests(enc, (t.as_py() for t in b.column("t")))
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the ids themselves."""

    def run(batches):
        enc = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array([enc.encode(t) for t in b.column("t").to_pylist()], pa.list_(pa.int32()))], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: id and the decoded text."""

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = []
            for ids in b.column("x").to_pylist():
                d = Decoder(enc.m)
                texts.append(d.feed(ids or []) + d.end())
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(texts, pa.string())], [id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("i"), F.col(ids_col).alias("x")).mapInArrow(run, f"`{id_col}` {kind}, text string")
