"""Word-level BPE vocabularies of the ``tokenizers`` format, unit by unit.

A *unit* is what stands between two blanks (space, tab, line ends) of a text.  For a vocabulary that
drops white space and never joins across it, a text's tokens are those of its
units in order, so each distinct unit is encoded once per worker and looked up
afterwards.  Units made of Latin letters, digits, punctuation and ASCII white
space are encoded here, all new ones of a batch at once (merges in numpy); any
other unit (other scripts, control characters, special tokens' strings) goes
to the library itself.  Tests hold the ids against the library's.

Caches are bounded and keep what was used lately (``Recent``).
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CACHED = 300_000  # entries of one generation of a cache
MAX_VECTOR = 64       # longer pieces are merged by the library
SLICE = 1 << 20       # code points of a text that are split at once
GROUP = 1 << 22       # code points whose units are numbered at once
NO_MERGE = np.int32(np.iinfo(np.int32).max)
#: Letters of ``SIMPLE``, with at most one mark behind them.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+[.,;:!?]?$"
MARKS = ".,;:!?"
#: (numbers of all units, where each unit's begin, how many they are)
Answer = tuple[np.ndarray, np.ndarray, np.ndarray]
#: Latin characters that normal form C keeps and that have a one-character lower case.
SIMPLE = re.compile(r"[\t-\r\x20-\x7e¡-¬®-įı-ɏ]*")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(other)) for b in range(256)]


class Recent:
    """A bounded cache of two generations: when the young one is full it becomes
    the old one, and what is still asked for moves on to the next."""

    def __init__(self, size: int = MAX_CACHED):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        v = self.young.get(key)
        if v is None:
            v = self.old.get(key)
            if v is not None:
                self.put(key, v)
        return v

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class WordBpe:
    def __init__(self, spec: str):
        import regex
        from tokenizers import Tokenizer

        d = json.loads(spec)
        model = d["model"]
        self.library = Tokenizer.from_str(spec)
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in d["added_tokens"]) or r"(?!)")
        self.pattern = regex.compile(d["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.symbols = _byte_symbols()
        self.inner = np.array([self.vocab[s] for s in self.symbols], np.int32)
        self.final = np.array([self.vocab[s + self.suffix] for s in self.symbols], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([self.vocab[a] << 32 | self.vocab[b] for a, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], np.arange(len(pairs))[order], made[order]
        #: by rank: the token that the merge makes
        self.made_by_rank = made.astype(np.int32)
        self.shift, self.owner, self.rank_at = _displaced(keys, max(self.vocab.values()) + 1)
        #: the ranks of pairs of bytes: inside a word, and at its end
        self.first = [self._ranked(self.inner[:, None], last[None, :]) for last in (self.inner, self.final)]
        self.units = Recent(MAX_CACHED // 4)      # units that are not plain, and their pieces
        probe = "Don't  stop,\tnow: x<y\n3.14"
        if self.library_ids(probe) != [i for u in probe.split() for i in self.library_ids(u)]:
            raise ValueError("this vocabulary joins tokens across white space")

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    # -- merges -----------------------------------------------------------
    def _ranked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge; ``NO_MERGE`` if there is none."""
        slot = self.shift.take(a) + b
        return np.where(self.owner.take(slot) == a, self.rank_at.take(slot), NO_MERGE)

    def _rounds(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their ids) of words of one length, given as rows of bytes: the
        lowest-ranked pair, leftmost first, is merged until none is left.

        After k rounds every row that is still live has k symbols less, so rows
        need no padding."""
        ids = self.inner[raw]
        ids[:, -1] = self.final[raw[:, -1]]
        where = np.arange(len(raw))
        rank = self.first[0][raw[:, :-1], raw[:, 1:]]
        rank[:, -1:] = self.first[1][raw[:, -2:-1], raw[:, -1:]]
        while True:
            if rank.shape[1] == 0:
                yield where, ids
                return
            at = rank.argmin(1)
            best = rank[np.arange(len(rank)), at]
            live = best < NO_MERGE
            if not live.all():
                yield where[~live], ids[~live]
                if not live.any():
                    return
                where, ids, rank, at, best = where[live], ids[live], rank[live], at[live], best[live]
            rows = np.arange(len(ids))
            later = np.arange(ids.shape[1] - 1) > at[:, None]      # drop the second symbol of the pair
            ids = np.where(later, ids[:, 1:], ids[:, :-1])
            ids[rows, at] = self.made_by_rank[best]
            rank = np.where(np.arange(rank.shape[1] - 1) >= at[:, None], rank[:, 1:], rank[:, :-1])
            for side in (at - 1, at):
                ok = (side >= 0) & (side < rank.shape[1])
                r, c = rows[ok], side[ok]
                rank[r, c] = self._ranked(ids[r, c], ids[r, c + 1])

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, where each word's begin, how many they are)."""
        data, starts, size = _bytes_of(words)
        found = []
        for n in np.unique(size).tolist():
            ks = np.flatnonzero(size == n)
            if 0 < n <= MAX_VECTOR:
                found += [(ks[rows], ids) for rows, ids in self._rounds(data[starts[ks][:, None] + np.arange(n)])]
            elif n:
                found += [(ks[i:i + 1], np.array([self.library_ids(words[k].as_py())])) for i, k in enumerate(ks.tolist())]
        count = np.zeros(len(size), np.int64)
        for ks, ids in found:
            count[ks] = ids.shape[1]
        begin = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), "<u4")
        for ks, ids in found:
            flat[begin[ks][:, None] + np.arange(ids.shape[1])] = ids
        return flat, begin, count

    def merged(self, words: Sequence[str]) -> dict[str, bytes]:
        """The ids of words, as little-endian 32-bit numbers."""
        flat, begin, count = self.merge(pa.array(words, pa.large_string()))
        data = flat.tobytes()
        return {w: data[i:j] for w, i, j in zip(words, (4 * begin).tolist(), (4 * (begin + count)).tolist(), strict=True)}

    # -- units ------------------------------------------------------------
    def is_simple(self, unit: str) -> bool:
        return SIMPLE.fullmatch(unit) is not None and self.special.search(unit) is None

    def split(self, unit: str) -> list[str] | None:
        """The pieces of a simple unit, None for any other."""
        return self.pattern.findall(unit.lower()) if self.is_simple(unit) else None

    def solve(self, units: Sequence[str]) -> dict[str, bytes]:
        """The ids of new units, as little-endian 32-bit numbers."""
        out: dict[str, bytes] = {}
        split: dict[str, list[str]] = {}
        known: dict[str, bytes | None] = {}
        for u in units:
            found = self.split(u)
            if found is None:
                out[u] = np.array(self.library_ids(u), "<u4").tobytes()
                continue
            split[u] = found
            for p in found:
                if p not in known:
                    known[p] = self.units.get(p)
        new = [p for p, v in known.items() if v is None]
        for p, ids in self.merged(new).items():
            known[p] = ids
            self.units.put(p, ids)
        for u, found in split.items():
            out[u] = known[found[0]] if len(found) == 1 else b"".join([known[p] for p in found])
        return out

    def answer(self, units: pa.Array) -> Answer:
        """The ids of distinct units.  Plain words, with at most one mark behind
        them, are merged anew in each group of texts; others are cached."""
        plain = pc.match_substring_regex(units, PLAIN)
        words = pc.utf8_lower(units.filter(plain))
        coded = pc.ascii_rtrim(words, MARKS).dictionary_encode()
        flat, begin, count = self.merge(coded.dictionary)
        stem = coded.indices.to_numpy()
        data, starts, size = _bytes_of(words)
        marked = size > _bytes_of(coded.dictionary)[2][stem]
        sizes = count[stem] + marked
        after = np.cumsum(sizes)
        blob = np.empty(int(sizes.sum()), "<u4")
        blob[after[marked] - 1] = self.final[data[(starts + size)[marked] - 1]]
        inside = np.ones(len(blob), bool)
        inside[after[marked] - 1] = False
        blob[inside] = flat[places(begin[stem], count[stem])]
        rest = cached(units.filter(pc.invert(plain)).to_pylist(), self.units, self.solve)
        other, other_begin, other_sizes = packed(rest, b"", 4)
        is_plain = plain.to_numpy(zero_copy_only=False)
        both = np.empty((2, len(units)), np.int64)
        both[:, is_plain] = after - sizes, sizes
        both[:, ~is_plain] = other_begin + len(blob), other_sizes
        return np.concatenate([blob, other]), both[0], both[1]

    def encode_all(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        return looked_up(texts, self.answer, 0)


def _displaced(keys: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shift, owner, rank): the merges (left << 32 | right, by rank) as a sparse table whose rows,
    one for each left token, lie over one another in one array.  A row's shift is the first of a
    fixed series at which its entries meet no others, so a pair is looked up at
    shift[left] + right and is there exactly if left owns the place."""
    left, right = keys >> 32, keys & 0xFFFFFFFF
    room = max(8 * len(keys), tokens)
    shift = np.zeros(tokens, np.int32)
    owner = np.full(room + tokens, -1, np.int32)
    rank = np.full(room + tokens, NO_MERGE, np.int32)
    order = np.argsort(left, kind="stable")
    starts = np.flatnonzero(np.diff(left[order], prepend=-1))
    sizes = np.diff(starts, append=len(order))
    at = 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        row = order[starts[k]:starts[k] + sizes[k]]
        while (owner[at + right[row]] >= 0).any():
            at = (at + 7919) % room
        shift[left[row[0]]] = at
        owner[at + right[row]] = left[row[0]]
        rank[at + right[row]] = row
        at = (at + 7919) % room
    return shift, owner, rank


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte of each word, its number of bytes)."""
    words = pa.concat_arrays([words]).cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    data = words.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets[:-1], np.diff(offsets)


def places(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of ``count`` numbers each, one after another."""
    after = np.cumsum(count)
    total = int(after[-1]) if len(after) else 0
    kind = np.int32 if max(total, int(begin.max(initial=0)) + total) < 1 << 31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((begin - after + count).astype(kind), count)


def cached(units: list[str], cache: Recent, solve) -> list[bytes]:
    """The bytes of distinct units; those that the cache lacks are solved together."""
    got = list(map(cache.young.get, units))
    gaps = [i for i, g in enumerate(got) if g is None]
    if gaps:
        gc.disable()   # millions of short-lived strings, no cycles
        try:
            missing = [units[i] for i in gaps]
            fresh = {u: v for u in missing if (v := cache.old.get(u)) is not None}
            fresh |= solve([u for u in missing if u not in fresh])
            for i, u in zip(gaps, missing, strict=True):
                got[i] = fresh[u]
                cache.put(u, got[i])
        finally:
            gc.enable()
    return got


def packed(found: list[bytes], between: bytes, width: int) -> Answer:
    """``found``, each followed by ``between``, as numbers of ``width`` bytes."""
    sizes = (np.fromiter(map(len, found), np.int64, len(found)) + len(between)) // width
    return np.frombuffer(between.join([*found, b""]), f"<u{width}"), np.cumsum(sizes) - sizes, sizes


def slices(text: str) -> Iterator[str]:
    """The text cut at single spaces into parts of about ``SLICE`` code points."""
    at = 0
    while len(text) - at > SLICE:
        cut = text.find(" ", at + SLICE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def looked_up(texts: Sequence[str], answer: Callable[[pa.Array], Answer], drop: int) -> Iterator[bytes]:
    """For each text, its units' answers in a row, without the last ``drop`` bytes.
    Units of many texts are numbered at once, distinct ones are answered, and the
    answers are dealt out by number."""
    done: list[bytes] = []      # of the current text
    waiting: list[str] = []
    ends: list[bool] = []       # whether a part is the last of its text
    size = 0

    def flush() -> Iterator[bytes]:
        if not waiting:
            return
        lists = pc.split_pattern(pa.array(waiting, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        blob, starts, sizes = answer(coded.dictionary)
        number = coded.indices.to_numpy()
        many = sizes.take(number)
        after = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
        borders = after[lists.offsets.to_numpy()].tolist()
        dealt = blob.take(places(starts.take(number), many))
        for k, last in enumerate(ends):
            done.append(dealt[borders[k]:borders[k + 1]].tobytes())
            if last:
                whole = done[0] if len(done) == 1 else b"".join(done)
                yield whole[:len(whole) - drop]
                done.clear()
        waiting.clear()
        ends.clear()

    for text in texts:
        for blank in "\n\t\r":      # as good as a space, and one code point as well
            text = text.replace(blank, " ")
        parts = list(slices(text))
        for k, part in enumerate(parts):
            waiting.append(part)
            ends.append(k == len(parts) - 1)
            size += len(part)
            if size >= GROUP:
                yield from flush()
                size = 0
    yield from flush()


@lru_cache(maxsize=2)
def coder(spec: str) -> WordBpe:
    """One coder per Python worker and vocabulary."""
    return WordBpe(spec)


def read_spec(path: str) -> str:
    """The vocabulary file, read once by the driver: a fixed file of a few MB,
    which travels with the task closure."""
    with open(path, encoding="utf-8") as f:
        return f.read()
