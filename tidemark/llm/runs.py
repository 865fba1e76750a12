"""Periodic runs of words, found in a grammar of each text.

A run is a maximal stretch of words with smallest period ``q`` and at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` words.

1. Re-Pair over the word ids: repeated pairs of neighbouring symbols become
   nonterminals, round by round.  A round replaces every pair that ranks above
   the pairs it overlaps (counts by powers of two first, ties by a hash), so a
   round costs one pass and rounds are few.  What is left is joined pairwise up
   to one symbol per text.
2. Every run lies inside some nonterminal and crosses the boundary between its
   two halves.  For each nonterminal, once, whatever the number of places it
   derives: one half holds two periods of such a run, so the period is a distance
   at which the three words at the boundary come again; the periodic stretch
   around the boundary is measured by comparing prefix hashes.
3. The stretches are translated to all places the nonterminal derives, and
   stretches of one period that overlap by a period are merged.

Texts are worked on together, in groups of about ``GROUP_WORDS`` words, with
array operations; each text has its own symbols.  Stretches are compared word
by word at the end, so a hash collision cannot give a wrong run: it makes the
group start again with another hash.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

MIN_LENGTH = 6
MIN_EXPONENT = 4
GROUP_WORDS = 200_000
CANDIDATES = 1_000_000          # boundary periods measured at once
_PRIMES = (2147483647, 2147483629)

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
FOUND = StructType([StructField("runs", ArrayType(RUN)), StructField("best", RUN),
                    StructField("collapsed", StringType())])


# ---- the grammar ----------------------------------------------------------------------------
class Grammar:
    """Nonterminals over the words ``ids`` of texts ``doc`` (symbols are not shared
    between texts).

    ``start, mid, end``: one place each nonterminal derives and the boundary in it;
    ``rule, at``: all places, by nonterminal."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray):
        n = len(ids)
        self.top = int(ids.max()) + 1 if n else 0
        self.span = self.top + n + 1                    # above every symbol
        sym, lo = ids.astype(np.int64), np.arange(n)
        hi = lo + 1
        known, names = np.empty(0, np.int64), np.empty(0, np.int64)
        nodes, places = [], []
        # Pairs that may come again: all at first, later those that did or are new.
        active = doc[1:] == doc[:-1]
        while active.any():
            at = np.flatnonzero(active)
            keys = sym[at] * self.span + sym[at + 1]
            pairs, which, times = np.unique(keys, return_inverse=True, return_counts=True)
            again = times[which] > 1
            if not again.any():
                break
            rank = np.empty(len(pairs), np.int64)
            mixed = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            order = np.lexsort((pairs, mixed, np.frexp(times.astype(float))[1]))
            rank[order] = np.arange(1, len(pairs) + 1)
            score = np.zeros(len(sym) + 1, np.int64)    # score[i + 1]: pair at i
            score[at + 1] = np.where(again, rank[which], 0)
            own, before = score[1:], score[:-1]
            after = np.append(score[2:], 0)
            # Of equal pairs in a row (a a a a) every second one.
            first = np.flatnonzero((own != before) | (own == 0))
            place = np.arange(len(own))
            even = (place - first[np.searchsorted(first, place, "right") - 1]) % 2 == 0
            take = np.flatnonzero((own > 0) & (own >= before) & (own >= after) & even)
            taken = sym[take] * self.span + sym[take + 1]
            made, example = np.unique(taken, return_index=True)
            seen = np.searchsorted(known, made)
            old = np.zeros(len(made), bool)
            if len(known):
                old = known[np.minimum(seen, len(known) - 1)] == made
            fresh = np.flatnonzero(~old)
            symbol = np.empty(len(made), np.int64)
            symbol[old] = names[seen[old]]
            symbol[fresh] = self.top + np.arange(len(fresh))
            self.top += len(fresh)
            e = take[example[fresh]]
            nodes.append((lo[e], lo[e + 1], hi[e + 1]))
            known = np.concatenate([known, made[fresh]])
            names = np.concatenate([names, symbol[fresh]])
            order = np.argsort(known)
            known, names = known[order], names[order]
            result = symbol[np.searchsorted(made, taken)]
            places.append((result, lo[take]))
            # Replace: the left symbol becomes the nonterminal, the right one goes.
            repeated = np.zeros(len(sym), bool)
            repeated[at[again]] = True
            new = np.zeros(len(sym), bool)
            new[take] = True
            sym[take], hi[take] = result, hi[take + 1]
            stay = np.ones(len(sym), bool)
            stay[take + 1] = False
            sym, lo, hi, doc = sym[stay], lo[stay], hi[stay], doc[stay]
            repeated, new = repeated[stay], new[stay]
            active = (repeated[:-1] | new[:-1] | new[1:]) & (doc[1:] == doc[:-1])
        self.first_rule = int(ids.max()) + 1 if n else 0
        self._join(lo, hi, doc, nodes, places)

    def _join(self, lo, hi, doc, nodes, places) -> None:
        """What is left is joined pairwise, level by level, to one symbol per text."""
        while True:
            begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else lo
            if len(begins) == len(doc):
                break
            nth = np.arange(len(doc)) - np.repeat(begins, np.diff(np.append(begins, len(doc))))
            left = np.flatnonzero((nth % 2 == 0)[:-1] & (doc[1:] == doc[:-1]))
            nodes.append((lo[left], lo[left + 1], hi[left + 1]))
            places.append((self.top + np.arange(len(left)), lo[left]))
            self.top += len(left)
            hi[left] = hi[left + 1]
            stay = np.ones(len(doc), bool)
            stay[left + 1] = False
            lo, hi, doc = lo[stay], hi[stay], doc[stay]
        cat = lambda parts, i: (np.concatenate([p[i] for p in parts]) if parts
                                else np.empty(0, np.int64))
        self.start, self.mid, self.end = (cat(nodes, i) for i in range(3))
        rule, at = cat(places, 0) - self.first_rule, cat(places, 1)
        order = np.argsort(rule, kind="stable")
        self.rule, self.at = rule[order], at[order]


# ---- runs across boundaries -------------------------------------------------------------------
class _Prefixes:
    """Hashes of all stretches of the words, modulo two primes."""

    def __init__(self, ids: np.ndarray, seed: int):
        draw = np.random.default_rng(seed)
        self.rows = []
        for p in _PRIMES:
            base = int(draw.integers(1 << 20, p - 1))
            power = np.ones(len(ids) + 1, np.uint64)
            done, step = 1, base
            while done <= len(ids):
                part = power[:min(done, len(ids) + 1 - done)]
                power[done:done + len(part)] = part * np.uint64(step) % np.uint64(p)
                step = step * step % p
                done *= 2
            value = draw.integers(1, p, int(ids.max()) + 1 if len(ids) else 0).astype(np.uint64)
            sums = np.zeros(len(ids) + 1, np.uint64)
            np.cumsum(value[ids] * power[:-1] % np.uint64(p), out=sums[1:])
            self.rows.append((np.uint64(p), sums % np.uint64(p), power))

    def equal(self, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
        """Whether ``length`` words from ``i`` on equal those from ``j >= i`` on."""
        same = np.ones(len(i), bool)
        for p, sums, power in self.rows:
            a = (sums[i + length] + p - sums[i]) % p
            b = (sums[j + length] + p - sums[j]) % p
            same &= a * power[j - i] % p == b
        return same

    def forward(self, i, j, most) -> np.ndarray:
        """How many words from ``i`` and ``j`` on are equal, ``most`` at most."""
        return self._extend(i, j, most, 1)

    def backward(self, i, j, most) -> np.ndarray:
        """How many words before ``i`` and ``j`` are equal, ``most`` at most."""
        return self._extend(i, j, most, -1)

    def _extend(self, i, j, most, way) -> np.ndarray:
        got = np.zeros(len(i), np.int64)
        step = 1 << (int(most.max()).bit_length() - 1 if len(most) and most.max() > 0 else 0)
        while step:
            room = np.flatnonzero(got + step <= most)
            off = got[room] if way > 0 else -got[room] - step
            ok = room[self.equal(i[room] + off, j[room] + off, step)]
            got[ok] += step
            step >>= 1
        return got


def _trigrams(ids: np.ndarray, doc: np.ndarray):
    """The places of three-word windows that come again in their text: windows
    numbered, as sorted ``window * n + place``; and each place's window (-1: once)."""
    n = len(ids)
    name = np.full(n, -1, np.int64)
    here = np.arange(max(0, n - 2))
    here = here[doc[here] == doc[here + 2]]
    span = int(ids.max()) + 1 if n else 1
    pair = np.zeros(len(here), np.int64)
    for depth in (1, 2):        # pairs first; only those that come again go on
        left = ids[here] if depth == 1 else pair
        key = left.astype(np.int64) * span + ids[here + depth]
        _, pair, times = np.unique(key, return_inverse=True, return_counts=True)
        more = times[pair] > 1
        here, pair = here[more], pair[more]
    name[here] = pair
    return np.sort(pair * n + here), name


def _ranges(lo: np.ndarray, hi: np.ndarray):
    """All numbers of the ranges ``[lo, hi)``, with the index of their range."""
    size = np.maximum(hi - lo, 0)
    owner = np.repeat(np.arange(len(lo)), size)
    skip = np.cumsum(size) - size
    return owner, np.arange(int(size.sum())) - skip[owner] + lo[owner]


def boundary_runs(g: Grammar, ids: np.ndarray, doc: np.ndarray, seed: int):
    """``(node, start, end, period)``: the periodic stretches that cross a node's
    boundary, inside the node's own place."""
    n = len(ids)
    windows, name = _trigrams(ids, doc)
    found = []
    prefixes = None
    for right in (True, False):
        # Three words at the boundary, and half of the longer part at most as period.
        x = g.mid - 1 if right else g.mid - 2
        reach = (g.end - g.mid) // 2 if right else (g.mid - g.start) // 2
        node = np.flatnonzero((reach > 0) & (x >= g.start))
        node = node[name[x[node]] >= 0]
        base = name[x[node]] * n + x[node]
        if right:
            lo = np.searchsorted(windows, base, "right")
            hi = np.searchsorted(windows, base + reach[node], "right")
        else:
            lo = np.searchsorted(windows, base - reach[node], "left")
            hi = np.searchsorted(windows, base, "left")
        some = hi > lo
        node, lo, hi = node[some], lo[some], hi[some]
        if not len(node):
            continue
        prefixes = prefixes or _Prefixes(ids, seed)
        cuts = np.flatnonzero(np.diff(np.cumsum(hi - lo) // CANDIDATES)) + 1
        for part in np.split(np.arange(len(node)), cuts):
            owner, w = _ranges(lo[part], hi[part])
            k = node[part][owner]
            q = np.abs(windows[w] % n - x[k])
            anchor = g.mid[k] - 1 - (0 if right else q)
            inside = (anchor >= g.start[k]) & (anchor + q < g.end[k])
            k, q, anchor = k[inside], q[inside], anchor[inside]
            e = anchor + q + prefixes.forward(anchor, anchor + q, g.end[k] - anchor - q)
            s = anchor - prefixes.backward(anchor, anchor + q, anchor - g.start[k])
            ok = e - s >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q)
            found.append((k[ok], s[ok], e[ok], q[ok]))
    if not found:
        return [np.empty(0, np.int64)] * 4
    k, s, e, q = (np.concatenate(c) for c in zip(*found))
    # Multiples of a period give the same stretch: the smallest one stays.
    order = np.lexsort((q, e, s, k))
    k, s, e, q = k[order], s[order], e[order], q[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return k[first], s[first], e[first], q[first]


def _merged(s, e, q):
    """Stretches of one period that overlap by a period or more become one."""
    order = np.lexsort((-e, s, q))
    s, e, q = s[order], e[order], q[order]
    if not len(s):
        return s, e, q
    lift = (np.cumsum(np.append(False, q[1:] != q[:-1]))) * (int(e.max()) + 1)
    ends = np.maximum.accumulate(e + lift)
    first = np.append(True, (s[1:] + lift[1:] > ends[:-1] - q[1:]) | (q[1:] != q[:-1]))
    last = np.append(np.flatnonzero(first)[1:] - 1, len(s) - 1)
    s, e, q = s[first], ends[last] - lift[last], q[first]
    order = np.lexsort((q, e, s))       # a stretch keeps its smallest period
    s, e, q = s[order], e[order], q[order]
    own = np.append(True, (s[1:] != s[:-1]) | (e[1:] != e[:-1]))
    return s[own], e[own], q[own]


def find_runs(ids: np.ndarray, doc: np.ndarray):
    """``(start, end, period)`` of all runs of the texts, by start, then period."""
    if len(ids) < MIN_LENGTH:
        return [np.empty(0, np.int64)] * 3
    g = Grammar(ids, doc)
    for seed in count(1):
        k, s, e, q = boundary_runs(g, ids, doc, seed)
        # All places of the nodes with a stretch.
        owner, p = _ranges(np.searchsorted(g.rule, k, "left"), np.searchsorted(g.rule, k, "right"))
        move = g.at[p] - g.start[k[owner]]
        s, e, q = _merged(s[owner] + move, e[owner] + move, q[owner])
        if all(np.array_equal(ids[a:b - c], ids[a + c:b])
               for a, b, c in zip(s.tolist(), e.tolist(), q.tolist())):
            order = np.lexsort((q, s))
            return s[order], e[order], q[order]


# ---- texts ------------------------------------------------------------------------------------
def _best(runs):
    """The run of greatest length over period; then smallest start, smallest period."""
    top = None
    for r in runs:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    return top


def _group(texts: list[list[bytes]]):
    """For each text's words its runs ``(start, length, period)`` and its collapsed words."""
    ids: list[int] = []
    symbols = 0
    for words in texts:
        own = dict(zip(dict.fromkeys(words), count(symbols)))
        symbols += len(own)
        ids.extend(map(own.__getitem__, words))
    sizes = np.array([len(w) for w in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    s, e, q = find_runs(np.array(ids, np.int64), np.repeat(np.arange(len(texts)), sizes))
    # A text without words begins where the next one does, which is the one found.
    of = np.searchsorted(begin, s, "right") - 1
    gone = np.zeros(len(ids) + 1, np.int64)
    np.add.at(gone, s + q, 1)
    np.add.at(gone, e, -1)
    gone = np.cumsum(gone)[:-1] > 0
    runs: dict[int, list] = {}
    for t, a, b, c in zip(of.tolist(), s.tolist(), e.tolist(), q.tolist()):
        runs.setdefault(t, []).append((a - int(begin[t]), b - a, c))
    for t, words in enumerate(texts):
        if t in runs:
            at = int(begin[t])
            words = [words[i] for i in np.flatnonzero(~gone[at:at + len(words)])]
        yield runs.get(t, []), words


def runs_of(texts: list[bytes]):
    """``(runs, collapsed text)`` of each text, in order."""
    held: list[list[bytes]] = []
    size = 0
    for raw in texts:
        held.append(raw.split())
        size += len(held[-1])
        if size >= GROUP_WORDS:
            for runs, words in _group(held):
                yield runs, b" ".join(words)
            held, size = [], 0
    for runs, words in _group(held):
        yield runs, b" ".join(words)


def _struct(rows) -> pa.StructArray:
    """``(start, length, period)`` rows, or None for a null one."""
    kind = pa.int64()
    return pa.StructArray.from_arrays(
        [pa.array([None if r is None else r[i] for r in rows], kind) for i in range(3)],
        ["start", "length", "period"], mask=pa.array([r is None for r in rows], pa.bool_()))


@F.arrow_udf(FOUND)
def _found(texts: pa.Array) -> pa.Array:
    rows = list(runs_of([t or b"" for t in texts.cast(pa.binary()).to_pylist()]))
    flat = [r for runs, _ in rows for r in runs]
    offsets = pa.array(np.cumsum([0] + [len(runs) for runs, _ in rows]), pa.int32())
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(offsets, _struct(flat)),
         _struct([_best(runs) for runs, _ in rows]),
         pa.array([c for _, c in rows], pa.binary()).cast(pa.string())],
        ["runs", "best", "collapsed"])


def periodic_runs(text: Column | str) -> Column:
    """A struct per text: ``runs`` (array of start, length, period, in words from 0, by
    start, then period), ``best`` (greatest length over period; null without a run)
    and ``collapsed`` (the words that no run holds after its first period, joined by
    blanks).

    Words are stretches without ASCII white space.  A null or empty text, or one
    without a word, has no run and collapses to the empty text.  Equal texts give
    equal results; memory is bounded by the longest text, at some 300 bytes a word."""
    return _found.asNondeterministic()(text)


# ---- texts with a repeating end -------------------------------------------------------------------
def with_repeated_tail(text: Column, doc_id: Column) -> Column:
    """``text`` for most ids; where the CRC-32 of the id ends in 0, a text whose words
    from ``a`` on repeat with period ``p``, both drawn from the CRC.  A null id counts
    as the empty text; a text without a word stays."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(crc / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    tail = F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")
    return F.when((crc % 10 == 0) & (n > 0), tail).otherwise(text)
