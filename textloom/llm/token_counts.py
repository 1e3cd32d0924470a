"""Token counts of every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding is valid exactly if each pair of neighbouring tokens is
what the two tokens' joined string encodes to.  So the encoding of a word's
prefix ends in the one token t that (a) is a suffix of the prefix and (b) may
follow the last token of the prefix before it:

    count[i] = count[i - len(t)] + 1.

The last symbol of a word carries the end-of-word mark, hence two values for a
prefix: as the inside of a longer word and as a word that ends there.  Both are
kept per prefix string and shared by all words that begin alike.  The count of a
text's prefix is the count before its last unit plus that of the unit's prefix,
so the whole table comes from one pass without encoding any prefix anew.  That
holds in every script: the library's normaliser and split pattern give a unit's
pieces, and only a prefix that normalises differently from the whole (a letter
whose mark is still to come) is split anew from its last piece on.

The table is stored as differences, one signed byte per code point (first byte
1), or 32-bit numbers (first byte 4) where a difference does not fit a byte.
``tokens_at`` and ``longest_prefix`` answer truncation and budget questions
from it.  Rows never move.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import sub
from struct import error as StructError
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import MARKS, MAX_CACHED, PLAIN, Answer, Recent, WordBpe, places, cached, coder, looked_up, packed, read_spec
from .common import small_batches

NARROW, WIDE = b"\x01", b"\x04"
TAIL = 4    # bytes by which the tokens that may end a prefix are kept


@lru_cache(maxsize=1)
def _cluster() -> re.Pattern:
    """A character and those behind it that normalisation may join to it or reorder:
    marks with a combining class, second halves of compositions, vowels and
    finals of Hangul, and what this Python does not know."""
    joins = {*range(0x1160, 0x1200)}
    for k in range(sys.maxunicode + 1):
        ch = chr(k)
        halves = unicodedata.decomposition(ch).split()
        if len(halves) == 2 and halves[0][0] != "<":
            joins.add(int(halves[1], 16))
        if unicodedata.combining(ch) or unicodedata.category(ch) in ("Mn", "Mc", "Me", "Cn"):
            joins.add(k)
    ends = sorted(k for k in joins if k + 1 not in joins)
    begins = sorted(k for k in joins if k - 1 not in joins)
    joined = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(begins, ends, strict=True))
    return re.compile(f"[\\s\\S][{joined}]*")



class PrefixCounter:
    """Counts at every prefix of a unit, with bounded caches."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.units, self.stems = Recent(MAX_CACHED // 4), Recent(MAX_CACHED // 2)
        self.words, self.states = Recent(), Recent()
        self.pairs: dict[int, bool] = {}
        self.wide: set[str] = set()   # units with a difference beyond a byte
        back = {s: b for b, s in enumerate(bpe.symbols)}
        #: pair -> rank, and for each made token its rank and halves
        self.rank = dict(zip(bpe.keys.tolist(), bpe.ranks.tolist(), strict=True))
        born = {m: (r, k >> 32, k & 0xFFFFFFFF) for k, r, m in zip(bpe.keys.tolist(), bpe.ranks.tolist(), bpe.made.tolist(), strict=True)}
        if len(born) != len(bpe.keys):
            raise ValueError("a token of this vocabulary is made by two merges")
        self.right, self.left = ({k: self._edge(k, born, side) for k in bpe.vocab.values()} for side in (2, 1))
        self.inner: dict[bytes, int] = {}
        self.ended: dict[bytes, int] = {}
        suffix = bpe.suffix
        named = []
        for token, k in bpe.vocab.items():
            ends = token.endswith(suffix) and len(token) > len(suffix)
            body = token[:-len(suffix)] if ends else token
            if all(ch in back for ch in body):
                named.append((bytes(back[ch] for ch in body), k, ends))
        for raw, k, ends in named:      # tokens that no merge reaches never occur
            halves = born.get(k)
            if halves is None or self._may_follow(halves[1], halves[2], halves[0]):
                (self.ended if ends else self.inner)[raw] = k
        self.longest = max(map(len, [*self.inner, *self.ended]))
        self.near = self._near()

    def _edge(self, token: int, born: dict, side: int) -> list[tuple[int, int]]:
        """The symbols that stand at one edge while ``token`` is built, innermost
        first, each with the rank of the merge that takes it in."""
        out = [(token, len(born))]
        while token in born:
            rank, *_ = born[token]
            token = born[token][side]
            out.append((token, rank))
        return out[::-1]

    def _may_follow(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether a and b stay apart: no merge across their border comes before
        the merges that build them (with ``limit``: before that merge of both).

        Merges run in the order of their ranks, the left one first among equals;
        so at each moment one symbol of a and one of b meet at the border."""
        key = a << 32 | b
        known = self.pairs.get(key) if limit is None else None
        if known is None:
            xs, ys = self.right[a], self.left[b]
            i = j = 0
            known = True
            while True:
                (x, x_away), (y, y_away) = xs[i], ys[j]
                across = self.rank.get(x << 32 | y)
                if across is not None and across < x_away and across <= y_away:
                    known = limit is not None and across == limit and i == len(xs) - 1 and j == len(ys) - 1
                    break
                if i == len(xs) - 1 and j == len(ys) - 1:
                    break
                if j == len(ys) - 1 or (i < len(xs) - 1 and x_away <= y_away):
                    i += 1
                else:
                    j += 1
            if limit is None:
                if len(self.pairs) > MAX_CACHED:
                    self.pairs.clear()
                self.pairs[key] = known
        return known

    def _near(self) -> dict[bytes, tuple[list, list]]:
        """By the last bytes of a prefix, the tokens that may end it, longest first: (length, token),
        those inside a word and those at its end.  A key of ``TAIL`` bytes also names longer
        tokens, which are still to be looked up (None); a prefix goes by its longest key."""
        found: dict[bytes, tuple[dict, dict]] = {}
        for kind, tokens in enumerate((self.inner, self.ended)):
            for raw, k in tokens.items():
                short = len(raw) <= TAIL
                found.setdefault(raw[-TAIL:], ({}, {}))[kind][len(raw)] = k if short else None
        for key, kinds in found.items():
            for tokens, here in zip((self.inner, self.ended), kinds, strict=True):
                here.update((n, tokens[key[-n:]]) for n in range(1, len(key) + 1) if key[-n:] in tokens)
        return {k: tuple(sorted(here.items(), reverse=True) for here in kinds) for k, kinds in found.items()}

    def _last(self, word: bytes, n: int, before: list[tuple[int, int, int]], ends: list, tokens: dict[bytes, int]) -> tuple[int, int]:
        """(count, last token) of word[:n], from the states of shorter prefixes and
        the tokens that may end it."""
        pairs = self.pairs
        for size, t in ends:
            if t is None:
                t = tokens.get(word[n - size:n]) if size <= n else None
                if t is None:
                    continue
            if size == n:
                return 1, t
            count, last, _ = before[n - size]
            apart = pairs.get(last << 32 | t)
            if apart or (apart is None and self._may_follow(last, t)):
                return count + 1, t
        raise AssertionError(word[:n])

    def word(self, word: bytes) -> list[int]:
        """Counts of word[:1], word[:2], ... as words."""
        known = self.words.get(word)
        if known is not None:
            return known
        near, states, longest = self.near, self.states, self.longest
        before = [(0, -1, 0)]
        for i in range(1, len(word) + 1):
            state = states.get(word[:i]) if i <= longest else None
            if state is None:
                j = max(i - TAIL, 0)
                ends = near.get(word[j:i])
                while ends is None:
                    j += 1
                    ends = near.get(word[j:i])
                state = (*self._last(word, i, before, ends[0], self.inner), self._last(word, i, before, ends[1], self.ended)[0])
                if i <= longest:
                    states.put(word[:i], state)
            before.append(state)
        out = [state[2] for state in before[1:]]
        if len(word) <= longest:
            self.words.put(word, out)
        return out

    def _spans(self, text: str) -> list[tuple[int, int]]:
        """Where the library splits normalised text (its own tables of characters)."""
        return [span for _, span in self.bpe.library.pre_tokenizer.pre_tokenize_str(text)]

    def _pieces(self, text: str) -> list[str]:
        return [text[i:j] for i, j in self._spans(text)]

    def piece(self, piece: str) -> list[int]:
        """Counts of piece[:1], piece[:2], ..., each as a text of its own."""
        raw = piece.encode()
        c = self.word(raw)
        if len(raw) > len(piece):        # keep the places where characters end
            c = [c[k - 1] for k in accumulate(len(ch.encode()) for ch in piece)]
        if piece[0] == "'" and len(piece) > 2 and piece[1].isalpha():
            c = [c[0], c[0] + self.word(raw[1:2])[0], *c[2:]]   # a cut 're, 've or 'll is a quote and a letter
        return c

    def normal(self, text: str, spans: Iterable[tuple[int, int]]) -> list[int]:
        """Counts of text[:1], text[:2], ... of normalised text with these pieces."""
        counts: list[int] = []
        base = 0
        for i, j in spans:
            counts += [base] * (i - len(counts))
            counts += [base + x for x in self.piece(text[i:j])]
            base = counts[-1]
        return counts + [base] * (len(text) - len(counts))

    def plain(self, u: str) -> list[int]:
        """Counts of u[:1], u[:2], ... where no special token is in ``u``.

        ``u`` is normalised cluster by cluster (a character and what may combine
        with it).  A prefix that normalises to a prefix of the whole is looked up; one
        that does not (a letter whose mark is still to come) is split anew from
        its last piece on."""
        normalise = self.bpe.library.normalizer.normalize_str
        clusters = _cluster().findall(u)
        forms = [normalise(x) for x in clusters]
        text = "".join(forms)
        spans = self._spans(text)
        counts = [0, *self.normal(text, spans)]
        if [text[i:j] for i, j in spans] != self._pieces(normalise(u)):
            return [len(self.bpe.library_ids(u[:i])) for i in range(1, len(u) + 1)]
        starts = [a for a, _ in spans]
        out = []
        at = 0
        for cluster, form in zip(clusters, forms, strict=True):
            for k in range(1, len(cluster) + 1):
                part = form if k == len(cluster) else normalise(cluster[:k])
                if form.startswith(part):
                    out.append(counts[at + len(part)])
                else:
                    j = bisect_left(starts, at - 2) - 1     # a quote before it may still become 're, 've or 'll
                    i = starts[j] if j >= 0 else 0
                    out.append(counts[i] + sum(self.word(x.encode())[-1] for x in self._pieces(text[i:at] + part)))
            at += len(form)
        return out

    def unit(self, u: str) -> list[int]:
        """Counts of u[:1], u[:2], ..., each as a text of its own."""
        if self.bpe.is_simple(u):
            low = u.lower()
            return self.normal(low, (m.span() for m in self.bpe.pattern.finditer(low)))
        out: list[int] = []
        base = at = 0
        for m in self.bpe.special.finditer(u):
            # A special token counts once it is whole; until then it is text.
            out += [base + x for x in self.plain(u[at:m.end() - 1])]
            base += 1 + (out[m.start() - 1] - base if m.start() > at else 0)
            out.append(base)
            at = m.end()
        return out + [base + x for x in self.plain(u[at:])]

    def solve(self, units: list[str]) -> dict[str, bytes]:
        return {u: self._steps(u, self.unit(u)) for u in units}

    def solve_words(self, words: list[str]) -> dict[str, bytes]:
        """As ``solve``, for lower-case words of plain letters: each is one piece."""
        return {w: self._steps(w, self.piece(w) if w else []) for w in words}

    def _steps(self, unit: str, counts: list[int]) -> bytes:
        steps = list(map(sub, counts, [0, *counts]))
        try:
            return pack(f"{len(steps)}b", *steps)
        except StructError:
            self.wide.add(unit)
            return bytes(len(unit))

    def answer(self, units: pa.Array) -> Answer:
        """The tables of distinct units, each with a zero for the space behind it.  A plain
        word with at most one mark behind it has the table of the word, and the mark adds 1."""
        plain = pc.match_substring_regex(units, PLAIN)
        words = pc.utf8_lower(units.filter(plain))
        coded = pc.ascii_rtrim(words, MARKS).dictionary_encode()
        stems = coded.dictionary.to_pylist()
        flat, begin, count = packed(cached(stems, self.stems, self.solve_words), b"\0", 1)
        stem = coded.indices.to_numpy()
        if self.wide and not self.wide.isdisjoint(stems):
            bad = np.array([w in self.wide for w in stems])[stem]
            self.wide.update(units.filter(plain).filter(pa.array(bad)).to_pylist())
        body = count[stem] - 1
        marked = pc.utf8_length(words).to_numpy() > body
        sizes = body + marked + 1
        after = np.cumsum(sizes)
        blob = np.zeros(int(sizes.sum()), "<u1")
        inside = np.ones(len(blob), bool)
        inside[after - 1] = False
        inside[after[marked] - 2] = False
        blob[after[marked] - 2] = 1
        blob[inside] = flat.take(places(begin[stem], body))
        rest = cached(units.filter(pc.invert(plain)).to_pylist(), self.units, self.solve)
        other, other_begin, other_sizes = packed(rest, b"\0", 1)
        is_plain = plain.to_numpy(zero_copy_only=False)
        both = np.empty((2, len(units)), np.int64)
        both[:, is_plain] = after - sizes, sizes
        both[:, ~is_plain] = other_begin + len(blob), other_sizes
        return np.concatenate([blob, other]), both[0], both[1]

    def tables(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's table of differences; a space adds nothing."""
        for text, x in zip(texts, looked_up(texts, self.answer, 1), strict=True):
            if self.wide and not self.wide.isdisjoint(re.split("[ \n\t\r]", text)):
                d = [np.diff(self.unit(u), prepend=0, append=0) for u in re.split("[ \n\t\r]", text)]
                for k in d:   # the appended place is the space; the count stays as it is there
                    k[-1] = 0
                yield WIDE + np.concatenate(d)[:-1].astype("<i4").tobytes()
            else:
                yield NARROW + x


def differences(table: bytes) -> np.ndarray:
    return np.frombuffer(table, np.int8 if table[:1] == NARROW else "<i4", offset=1)


def counts_at(table: bytes, lengths) -> np.ndarray:
    """Tokens of the first n code points, for each n in ``lengths``."""
    total = np.concatenate([[0], np.cumsum(differences(table), dtype=np.int64)])
    return total[np.minimum(lengths, len(total) - 1)]


def _counter(spec: str, built: dict = {}) -> PrefixCounter:  # noqa: B006  one per Python worker
    if spec not in built:
        built.clear()
        built[spec] = PrefixCounter(coder(spec))
    return built[spec]


def prefix_tables(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, prefix_table) for every row; ``vocabulary`` is the
    path of a word-level BPE file.  A null text counts as empty: 0 tokens and an
    empty table.  Other columns of ``docs`` are not read."""
    spec = read_spec(vocabulary)

    @F.pandas_udf("n_bytes long, n_tokens long, prefix_table binary")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(spec)
        for batch in batches:
            texts = [t or "" for t in batch]
            tables = list(counter.tables(texts))
            yield pd.DataFrame({
                "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                "n_tokens": [int(differences(t).sum(dtype=np.int64)) for t in tables],
                "prefix_table": tables,
            })

    d = small_batches(docs).select(F.col(id_col).alias("_id"), count(F.col(text_col)).alias("_c"))
    return d.select(F.col("_id").alias(id_col), "_c.*")


def tokens_at(table: Column, n: Column) -> Column:
    """Tokens of the first ``n`` code points of the text behind ``table``."""

    @F.pandas_udf("long")
    def at(tables: pd.Series, lengths: pd.Series) -> pd.Series:
        return pd.Series([int(counts_at(t, [int(k)])[0]) for t, k in zip(tables, lengths, strict=True)])

    return at(table, n)


def longest_prefix(table: Column, budget: int) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens.  Counts
    are not monotonic (a cut word can take more tokens than the whole one)."""

    @F.pandas_udf("long")
    def longest(tables: pd.Series) -> pd.Series:
        return pd.Series([int(np.flatnonzero(counts_at(t, np.arange(len(differences(t)) + 1)) <= budget)[-1]) for t in tables])

    return longest(table)
