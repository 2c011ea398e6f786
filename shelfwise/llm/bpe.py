"""Byte-level BPE by a deterministic automaton over tokens.

Compiling. The automaton starts as one state with an arc for every byte. Each
merge (u, v), in order of rank, is one gadget: where a u arc leads to a state
that has a v arc, every state with a u arc gets an arc uv to that v arc's
target, and the u arcs move to a copy of their target without the v arc. All
arcs of one label lead to one state, so after all gadgets a label names the
state its arcs lead to, and a state's arcs follow from three tables: the parts
of each label, the time of its gadget, and the time at which label u's state
lost its v arc. The paths from the start state are the correct tokenizations
and no others.

Encoding. Every prefix of a word has just one path that spells it. So a word
is read once, byte by byte: at each byte the table of labels that end there
and the arcs tell the one label that ends this prefix's path. Nothing is tried
twice. All words of a batch that a worker has not met are read together, in
flat tables (numpy), and a prefix that several of them share is read for all
of them at once. Decoding emits the labels of the arcs.

Texts are parted between words into pieces, and each piece is known by a
64-bit hash of its bytes: a worker remembers the ids of the pieces it has met
in flat arrays. New pieces are split by the pre-tokenizer's published pattern.
A text that has a space before white space, where the pattern looks further,
is parted by the pattern itself, and where the added token's string stands its
id is given, as the vocabulary file asks.

Defined results: null and empty texts have no ids; ids of repeated rows are
equal; text after text is never joined. All of a text is encoded; a long one
is read in pieces cut where the pre-split parts it anyway.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jobs, text as texts_

VOCABULARY = "byte_bpe_50k.json"
# Fixed value: the published pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces and arcs a worker remembers before it starts anew.
REMEMBERED, ARCS = 400_000, 50_000
#: Bytes of text read at once, and of a part of a longer text.
BATCH, AT_ONCE = 2 << 20, 1 << 20
#: Bytes of the longest word read together with others, and ids written out at once.
WIDE, WRITTEN = 32, 1 << 16


def byte_letters() -> dict[str, int]:
    """The letters by which the vocabulary file writes bytes: printable ones
    stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


class Table:
    """Whole numbers by whole-number keys in two flat arrays (open addressing)."""

    def __init__(self, items: dict[int, int] | int):
        """Of these items, or empty with room for so many."""
        size = items if isinstance(items, int) else len(items)
        self.mask = (1 << max(4, (2 * size).bit_length())) - 1
        self.keys, self.values = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int32)
        if not isinstance(items, int):
            self.put(np.array(list(items), np.int64), np.array(list(items.values()), np.int32))

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that are new and differ from each other."""
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            # of those that want one free place the first gets it
            _, first = np.unique(at[left], return_index=True)
            first = first[self.keys[at[left[first]]] < 0]
            put = left[first]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.delete(left, first)
            at[left] = (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.int64(0x1E3779B97F4A7C15)) >> np.int64(29)) & np.int64(self.mask)

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        at = self._home(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], np.int32(default))
        more = np.flatnonzero((found != keys) & (found >= 0))
        while len(more):
            at[more] = (at[more] + 1) & self.mask
            found = self.keys[at[more]]
            hit = found == keys[more]
            out[more[hit]] = self.values[at[more[hit]]]
            more = more[~hit & (found >= 0)]
        return out


class Automaton:
    """Labels, gadgets and arcs compiled from a list of merges."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], added: dict[str, int]):
        self.label = {i: t for t, i in vocab.items()} | {i: s.encode() for s, i in added.items()}
        self.added = added
        size = max(self.label) + 1
        #: Parts of a label, the time of its gadget, and (u, v) -> when u's state lost v.
        self.left, self.right = array("i", [-1]) * size, array("i", [-1]) * size
        self.made = array("i", [-1]) * size
        self.lost: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        for b in range(256):
            i = vocab.get(bytes([b]))
            if i is not None:
                self.made[i] = 0
        for time, (u, v) in enumerate(merges, 1):
            self._gadget(vocab[u], vocab[v], vocab[u + v], time)
        self.live = {t: i for t, i in vocab.items() if self.made[i] >= 0}
        #: Length of the longest label by its last two bytes.
        self.longest: dict[bytes, int] = {}
        for t in self.live:
            self.longest[t[-2:]] = max(len(t), self.longest.get(t[-2:], 1))
        # labels read backwards: (node, byte) -> node, and the label that a node ends
        step, ends = {}, [-1]
        for t, i in self.live.items():
            node = 0
            for byte in reversed(t):
                key = node << 8 | byte
                if key not in step:
                    step[key] = len(ends)
                    ends.append(-1)
                node = step[key]
            ends[node] = i
        self.back, self.ends = Table(step), np.array(ends, np.int32)
        self.lost_at = Table(self.lost)
        self.parts = np.array([self.left, self.right, self.made])
        self.figures = Joiner([b"%d," % i for i in range(size)])
        self.letters = Joiner([self.label.get(i, b"") for i in range(size)])
        self.forget()

    def _gadget(self, u: int, v: int, uv: int, time: int) -> None:
        if self.made[u] < 0 or self.made[v] < 0 or self.made[uv] >= 0 or not self.follows(u, v):
            return                              # no path holds u then v
        self.left[uv], self.right[uv], self.made[uv] = u, v, time
        self.lost[u << 24 | v] = time

    def follows(self, u: int, v: int) -> bool:
        """Whether the state that u's arcs lead to has an arc v.

        The later of the two labels goes back to its gadget: v was put where
        its left part's arc was then; u's state was its right part's state
        just before. On the way no gadget may have taken the arc."""
        made, lost = self.made, self.lost
        time = 1 << 30
        while True:
            if lost.get(u << 24 | v, time + 1) <= time:
                return False
            a, b = made[u], made[v]
            if b > a:
                time = min(time, b)
                v = self.left[v]
            elif a > 0:
                time = min(time, a - 1)
                u = self.right[u]
            else:
                return True

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """Labels of the one path that spells a pre-split word."""
        live, longest, arcs = self.live.get, self.longest.get, self.arcs
        whole = live(word)
        if whole is not None:
            return (whole,)
        n = len(word)
        last = array("i", [-1]) * (n + 1)       # label that ends the path of each prefix
        before = array("i", [0]) * (n + 1)
        for i in range(1, n + 1):
            low = i - longest(word[i - 2 if i > 1 else 0:i], 1)
            for j in range(low if low > 0 else 0, i):
                t = live(word[j:i])
                if t is None:
                    continue
                if j:
                    key = last[j] << 24 | t
                    ok = arcs.get(key)
                    if ok is None:
                        if len(arcs) >= ARCS:
                            arcs.clear()
                        ok = arcs[key] = self.follows(last[j], t)
                    if not ok:
                        continue
                last[i], before[i] = t, j
                break
            else:
                raise ValueError(f"no path spells {word[:i][-80:]!r}")
        path, i = [], n
        while i:
            path.append(last[i])
            i = before[i]
        return tuple(path[::-1])

    def follow_all(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """``follows`` of many pairs."""
        left, right, made = self.parts
        u, v, at = u.astype(np.int64), v.astype(np.int64), np.arange(len(u))
        out, time = np.ones(len(u), bool), np.full(len(u), 1 << 30, np.int32)
        while len(at):
            gone = self.lost_at.get(u << 24 | v, (1 << 30) + 1) <= time
            out[at[gone]] = False
            a, b = made[u], made[v]
            go = ~gone & ((a > 0) | (b > 0))
            u, v, at, a, b = u[go], v[go], at[go], a[go], b[go]
            later = b > a
            time = np.minimum(time[go], np.where(later, b, a - 1))
            u, v = np.where(later, u, right[u]).astype(np.int64), np.where(later, left[v], v).astype(np.int64)
        return out

    def encode_words(self, letters: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode_word`` of many words of n <= WIDE bytes, the rows of
        ``letters`` (zeros behind): (ids, ids of each word)."""
        if not len(n):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        order = np.argsort(np.ascontiguousarray(letters).view(f"S{WIDE}").ravel(), kind="stable")
        letters, n = letters[order], n[order]
        # bytes that a word shares with the one before it
        shared = np.zeros(len(n), np.int64)
        unlike = letters[1:] != letters[:-1]
        shared[1:] = np.minimum(np.where(unlike.any(1), unlike.argmax(1), WIDE), np.minimum(n[1:], n[:-1]))
        most = int(n.max())
        last, before = np.full((most + 1, len(n)), -1, np.int32), np.zeros((most + 1, len(n)), np.int8)
        place = np.arange(len(n))
        for i in range(1, most + 1):
            fresh = (shared < i) & (n >= i)
            rows = np.flatnonzero(fresh)
            node = np.zeros(len(rows), np.int64)
            for size in range(1, i + 1):
                node = self.back.get(node << 8 | letters[rows, i - size], -1).astype(np.int64)
                on = node >= 0
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
                ends = self.ends[node]
                can = np.flatnonzero(ends >= 0)
                if size < i and len(can):
                    can = can[self.follow_all(last[i - size, rows[can]], ends[can])]
                last[i, rows[can]], before[i, rows[can]] = ends[can], i - size
                if len(can):
                    on = np.ones(len(rows), bool)
                    on[can] = False
                    rows, node = rows[on], node[on]
            # the others take it from the word they share it with
            source = np.maximum.accumulate(np.where(fresh, place, 0))
            last[i], before[i] = last[i, source], before[i, source]
        steps, at, rows = [], n.copy(), np.flatnonzero(n > 0)
        while len(rows):
            found = np.full(len(n), -1, np.int32)
            found[rows] = last[at[rows], rows]
            if (found[rows] < 0).any():
                raise ValueError("no path spells a word")
            at[rows] = before[at[rows], rows]
            steps.append(found)
            rows = rows[at[rows] > 0]
        table = np.empty((len(n), len(steps)), np.int32)
        table[order] = np.stack(steps[::-1], 1) if steps else table
        return table[table >= 0], (table >= 0).sum(1)

    def forget(self) -> None:
        """Empties the memory of pieces: number of a piece by its hash, and for
        number k its ids pool[begin[k]:begin[k + 1]]."""
        self.known = Table(REMEMBERED)
        self.begin, self.pool = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
        spelt = [s.encode() for s in self.added]
        ends = np.cumsum([len(s) for s in spelt], dtype=np.int64)
        keys = texts_.range_hashes(np.frombuffer(b"".join(spelt), np.uint8), ends - [len(s) for s in spelt], ends)
        self._remember(_positive(keys), np.array(list(self.added.values()), np.int32), np.ones(len(spelt), np.int64))

    def _remember(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        begin, _ = self.memory()
        self.known.put(keys, np.arange(len(begin) - 1, len(begin) - 1 + len(keys), dtype=np.int32))
        self.begin.append(begin[-1] + np.cumsum(counts))
        self.pool.append(ids)

    def memory(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.begin) > 1:
            self.begin, self.pool = [np.concatenate(self.begin)], [np.concatenate(self.pool)]
        return self.begin[0], self.pool[0]

    def ids_of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, limits by piece) of these byte ranges, which pre-split alone."""
        keys = _positive(texts_.range_hashes(data, start, end))
        number = self.known.get(keys, -1)
        if (number < 0).any():
            if len(self.memory()[0]) + len(keys) > REMEMBERED:
                self.forget()
                number = self.known.get(keys, -1)
            new = np.flatnonzero(number < 0)
            _, first = np.unique(keys[new], return_index=True)
            new = new[first]
            self._remember(keys[new], *self._encode_pieces(data, start[new], end[new]))
            number = self.known.get(keys, -1)
        begin, pool = self.memory()
        low, counts = begin[number], begin[number + 1] - begin[number]
        owner, place = texts_.spread(counts)
        return pool[low[owner] + place], np.concatenate([[0], np.cumsum(counts)])

    def _encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each piece) of these byte ranges."""
        # ASCII letters, maybe after a space, are one word of the pattern
        other = np.concatenate([[0], np.cumsum(~_LETTER[data], dtype=np.int64)])
        begin = start + (data[start] == 32)
        plain = (other[end] == other[begin]) & (end > begin) & (end - start <= WIDE)
        whole = np.flatnonzero(plain)
        at = start[whole][:, None] + np.arange(WIDE)
        letters = np.where(at < end[whole][:, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
        # the others are split by the pattern
        number, words, counts = {}, [], np.ones(len(start), np.int64)
        rest = np.flatnonzero(~plain)
        for k, a, b in zip(rest.tolist(), start[rest].tolist(), end[rest].tolist(), strict=True):
            some = data[a:b].tobytes().decode()
            own = [some] if (some[1:] if some[0] == " " else some).isalpha() else SPLIT.findall(some)
            counts[k] = len(own)
            words += [number.setdefault(w, len(number)) for w in own]
        spelt = [w.encode() for w in number]
        short = [w for w in spelt if len(w) <= WIDE]
        given = np.array(short, f"S{WIDE}").view(np.uint8).reshape(-1, WIDE) if short else np.zeros((0, WIDE), np.uint8)
        lengths = np.concatenate([(end - start)[whole], np.array([len(w) for w in short], np.int64)])
        ids, sizes = self.encode_words(np.concatenate([letters, given]), lengths)
        # words by number: whole pieces, short words, long words
        long = [self.encode_word(w) for w in spelt if len(w) > WIDE]
        ids = np.concatenate([ids, np.fromiter(itertools.chain.from_iterable(long), np.int32)])
        sizes = np.concatenate([sizes, np.array([len(x) for x in long], np.int64)])
        place, is_long = np.zeros(len(spelt), np.int64), np.array([len(w) > WIDE for w in spelt], bool)
        place[~is_long] = len(whole) + np.arange(len(short))
        place[is_long] = len(whole) + len(short) + np.arange(len(long))
        order = np.empty(int(counts.sum()), np.int64)
        first = np.cumsum(counts) - counts
        order[first[whole]] = np.arange(len(whole))
        owner, step = texts_.spread(counts[rest])
        order[first[rest][owner] + step] = place[words]
        limits = np.concatenate([[0], np.cumsum(sizes)])
        owner, step = texts_.spread(sizes[order])
        of = np.add.reduceat(sizes[order], first) if len(first) else counts
        return ids[limits[order][owner] + step], of

    def read(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text's place, ids, limits of the texts' ids) of some texts or parts
        of texts at a time, in order; null and empty texts have none."""
        data, offsets = texts_.buffer_of(texts)
        places, lows, highs, held = [], [], [], 0
        for k in range(len(texts)):
            low, end = int(offsets[k]), int(offsets[k + 1])
            while low < end:
                high = _cut(data, low, end)
                if places and held + high - low > BATCH:
                    yield self._read(data, places, lows, highs)
                    places, lows, highs, held = [], [], [], 0
                places.append(k)
                lows.append(low)
                highs.append(high)
                held += high - low
                low = high
        if places:
            yield self._read(data, places, lows, highs)

    def _read(self, data, places, lows, highs):
        first = lows[0]
        data = data[first:highs[-1]]
        limits = np.array([*lows, highs[-1]], np.int64) - first
        start = _piece_starts(data, limits)
        odd = [a for a in self.added if data.tobytes().find(a.encode()) >= 0] if self.added else []
        irregular = _irregular(data)
        rows = set(np.searchsorted(limits, irregular, "right") - 1)
        if odd:
            rows |= {k for k in range(len(places)) if any(data[limits[k]:limits[k + 1]].tobytes().find(a.encode()) >= 0 for a in odd)}
        if rows:
            # the pattern parts these texts itself
            own = [start[(start >= limits[k]) & (start < limits[k + 1])] for k in range(len(places))]
            for k in rows:
                pieces = self.split(data[limits[k]:limits[k + 1]].tobytes().decode())
                own[k] = limits[k] + np.cumsum([0, *[len(p.encode()) for p in pieces[:-1]]])
            start = np.concatenate(own)
        ids, ends = self.ids_of(data, start, np.r_[start[1:], len(data)])
        return np.array(places), ids, ends[np.searchsorted(start, limits)]

    def split(self, text: str) -> list[str]:
        """Words of a text by the pattern, and added tokens' strings."""
        parts = [text] if not self.added else regex.split("(" + "|".join(map(regex.escape, self.added)) + ")", text)
        return [w for p in parts for w in ([p] if p in self.added else SPLIT.findall(p))]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return [i for _, ids, _ in self.read(pa.array([text])) for i in ids.tolist()]

    def decode(self, ids: list[int]) -> str:
        """Text of the labels of these arcs (bytes that are no UTF-8 replaced)."""
        label = self.label
        return b"".join([label[i] for i in ids]).decode("utf-8", "replace")

    def digests(self, texts: pa.Array, keep_ids: bool = False) -> tuple[list[tuple[int, str, str]], list[np.ndarray]]:
        """For each text (number of ids, SHA-256 of the ids written out, of
        the decoded text); and the ids, all texts one after another."""
        n = [0] * len(texts)
        shas = [(hashlib.sha256(), hashlib.sha256()) for _ in range(len(texts))]
        decoders, kept = {}, []
        for places, ids, limits in self.read(texts):
            for low, high, k in _runs(places, limits):
                # a comma after each id, so that the first of a later part follows one
                text, _ = self.figures.joined(ids[low:high])
                text = text[:-1].tobytes()
                shas[k][0].update(b"," + text if n[k] else text)
                decoder = decoders.setdefault(k, codecs.getincrementaldecoder("utf-8")("replace"))
                shas[k][1].update(decoder.decode(self.letters.joined(ids[low:high])[0].tobytes()).encode())
                n[k] += high - low
            if keep_ids:
                kept.append(ids)
        for k, decoder in decoders.items():
            shas[k][1].update(decoder.decode(b"", True).encode())
        return [(c, a.hexdigest(), b.hexdigest()) for c, (a, b) in zip(n, shas, strict=True)], kept


class Joiner:
    """Byte strings by number, to be joined in any order."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the strings of these numbers one after another, their limits)."""
        length = self.length[numbers]
        limits = np.concatenate([[0], np.cumsum(length)])
        # each byte's place is its string's begin and the way from its own limit
        shift = np.repeat(self.begin[numbers] - limits[:-1], length)
        return self.data[shift + np.arange(limits[-1])], limits


def _runs(places: np.ndarray, limits: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first id, end, text) of each text's ids, at most WRITTEN at a time."""
    for k, low, end in zip(places.tolist(), limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        for at in range(low, end, WRITTEN):
            yield at, min(end, at + WRITTEN), k


def _positive(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(1)).view(np.int64)


def _cut(data: np.ndarray, low: int, end: int) -> int:
    """Where the part of a text from ``low`` ends: a long one is cut at a
    space between letters or digits, which parts any text."""
    at = low + AT_ONCE
    while at < end:
        some = data[at - 1:min(end, at + 4096) + 1]
        word = _PLAIN[some]
        spaces = np.flatnonzero((some[1:-1] == 32) & word[:-2] & word[2:])
        if len(spaces):
            return at + int(spaces[0])
        at += 4096
    return end


def _piece_starts(data: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Begins of texts, and spaces: a space belongs to the word after it."""
    opens = data == 32
    opens[limits[:-1]] = True
    return np.flatnonzero(opens)


def _irregular(data: np.ndarray) -> np.ndarray:
    """Places of spaces before white space (also that of other scripts)."""
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    spaces = np.flatnonzero(data == 32)
    a, b, c = (padded[spaces + k] for k in (1, 2, 3))
    wide = (((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
            | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((a == 0xE3) & (b == 0x80)))
    return spaces[_SPACE[a] | wide]


#: ASCII white space as the pattern sees it, letters, and letters and digits.
_SPACE = texts_.byte_table([*range(9, 14), *range(28, 33)])
_LETTER = texts_.byte_table([*range(65, 91), *range(97, 123)])
_PLAIN = texts_.byte_table([*range(48, 58), *range(65, 91), *range(97, 123)])
SPLIT = regex.compile(PATTERN)


def automaton(source: str) -> Automaton:
    """Compile from the text of a tokenizer file (byte-level BPE)."""
    data = json.loads(source)
    letters = byte_letters()
    spell = lambda s: bytes(letters[c] for c in s)
    added = {a["content"]: a["id"] for a in data["added_tokens"]}
    vocab = {spell(t): i for t, i in data["model"]["vocab"].items() if t not in added}
    merges = [tuple(map(spell, m if isinstance(m, list) else m.split(" "))) for m in data["model"]["merges"]]
    return Automaton(vocab, merges, added)


_COMPILED: dict[str, Automaton] = {}


def compiled(path: str) -> Automaton:
    """The automaton of a vocabulary file, one for each worker process."""
    if path not in _COMPILED:
        with open(path, encoding="utf-8") as f:
            _COMPILED[path] = automaton(f.read())
    return _COMPILED[path]


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def tokens(path: str | None = None, with_ids: bool = False):
    """Column function: struct of n_tokens, ids_sha256, decoded_sha256, and
    the ids if wanted."""
    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string" + (",ids:array<int>>" if with_ids else ">")

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        rows, ids = compiled(path or vocabulary_path()).digests(texts, with_ids)
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
        if with_ids:
            limits = np.concatenate([[0], np.cumsum([r[0] for r in rows])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(limits), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))))
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(columns)])

    return run


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Column ``ids`` (array of ids) beside all columns of docs."""
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        a = compiled(path or vocabulary_path())
        return pa.array([a.encode(t.as_py() or "") for t in texts], pa.list_(pa.int32()))

    return docs.withColumn("ids", run(F.col("text")))


def decode_ids(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Column ``decoded`` (text of ``ids``; null ids: empty) beside all columns."""
    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        a = compiled(path or vocabulary_path())
        return pa.array([a.decode(i.as_py() or []) for i in ids], pa.string())

    return rows.withColumn("decoded", run(F.col("ids")))


def digest_rows(docs: DataFrame) -> DataFrame:
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .select("doc_id", tokens()(F.col("text")).alias("d"))
            .select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256"))


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """All columns of docs and n_tokens, ids_sha256, decoded_sha256, ids (own
    columns of these names give way)."""
    new = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    name = "tokens"
    while name in docs.columns:
        name = "_" + name
    kept = [c for c in docs.columns if c not in new]
    return docs.select(*kept, tokens(path, True)(F.col("text").cast("string")).alias(name)).select(
        *kept, *[F.col(f"{name}.{c}").alias(c) for c in new])


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: doc_id, n_tokens, ids_sha256,
    decoded_sha256."""
    jobs.prepare(spark)
    return digest_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
