"""Evaluation passages in documents: spaced-seed hashing over words.

Fixed masks choose word positions of a window and ignore the others, so a damaged word spoils only the masks that look at
it. Hashes of the items' windows are joined with those of the documents' windows; around each hit the item is laid over the document
and the longest run of its words that agree, damaged ones tolerated, is counted.
"""

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import text as T

RUN = 14
MASKS = ("1110010111", "1101110011", "1011011101", "1111101001")
WINDOW, LEAST = 12, 8  # of so many words of a run at least so many agree but for common misreadings; others may be damaged in any way
BLOCK_WORDS = 400_000  # words of items whose seeds are shipped to the workers at a time
CELLS = 4_000_000  # words of items laid over documents at a time
TABLE_BITS = 22

# Characters that recognition mixes up share a class, named by one of them.
_CLASSES = {"l": "i", "1": "i", "|": "i", "f": "t", "b": "h", "e": "c", "0": "o", "a": "o", "q": "g"}
_PAIRS = (("rn", "m"), ("vv", "w"), ("ii", "u"))
_CYRILLIC = {"а": "a", "е": "e", "ё": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "п": "n", "к": "k", "т": "t", "в": "b", "н": "h", "м": "m", "и": "u", "0": "o", "з": "3"}
_LATIN = str.maketrans(_CLASSES)
_RUSSIAN = str.maketrans(_CYRILLIC)
_NOT_ASCII_WORD = re.compile(r"[^a-z0-9]")
_HAS_OTHER = re.compile("[Ͱ-῿Ⰰ-퟿]")
_LETTERS = re.compile(r"[^\W_]")
_NOT_WORD = re.compile(r"[\W_]")


@lru_cache(1 << 16)
def canonical(raw: str, folded: bool = False) -> str:
    """The word's form in which case, punctuation, accents and common misreadings make no difference; '' if nothing is left.

    Letters of Latin words outside ASCII are dropped, since wrong encodings leave anything there; of words like "à" nothing is left,
    unless accents are ``folded`` away instead.
    """
    s = raw.lower()
    if folded and not s.isascii() and not _HAS_OTHER.search(s):
        s = _NOT_WORD.sub("", "".join(ch for ch in unicodedata.normalize("NFD", s) if not unicodedata.combining(ch)))
        if not s.isascii():
            return s
    if not s.isascii():
        s = unicodedata.normalize("NFC", s)
        if _HAS_OTHER.search(s):
            return _NOT_WORD.sub("", s.translate(_RUSSIAN) if re.search("[Ѐ-ӿ]", s) else s)
    s = s.replace("|", "i")
    s = _NOT_ASCII_WORD.sub("", s)
    for a, b in _PAIRS:
        s = s.replace(a, b)
    return s.translate(_LATIN)


def code(raw: str) -> int:
    s = canonical(raw)
    return zlib.crc32(s.encode()) if s else T.NOTHING


def folded_code(raw: str) -> int:
    s = canonical(raw, True)
    return zlib.crc32(s.encode()) if s else T.NOTHING


def _close(a: str, b: str) -> bool:
    """One edit for words of four letters and more, two for those of eight and more; shorter words must agree."""
    allowed = 0 if len(b) < 4 else 1 if len(b) < 8 else 2
    if a == b:
        return True
    if not allowed or abs(len(a) - len(b)) > allowed:
        return False
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    rest = max(len(a), len(b)) - i - j  # differing middle
    if rest <= 1 or allowed == 1:
        return rest <= 1
    if len(set(a) - set(b)) + len(set(b) - set(a)) > 2 * allowed:  # an edit changes at most two letters of the sets
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > allowed:
            return False
    return row[-1] <= allowed


_FACTORS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) ** 3 % 2**64 | 1 for i in range(1, len(MASKS[0]) + 1)], np.uint64)


def seeds(codes: np.ndarray) -> list[np.ndarray]:
    """Of each mask, the hash of the window at each position (as many as there are whole windows)."""
    span = len(MASKS[0])
    n = max(len(codes) - span + 1, 0)
    out = []
    with np.errstate(over="ignore"):
        for m, mask in enumerate(MASKS):
            h = np.full(n, m, np.uint64)
            for j, bit in enumerate(mask):
                if bit == "1":
                    h += codes[j : j + n] * _FACTORS[j]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out.append(h ^ (h >> np.uint64(32)))
    return out


class Index:
    """Seeds of a block of items.

    Words of which nothing is left in canonical form are skipped, in items as in documents. ``folded`` indexes keep such words without their accents,
    and hold only items with some ``RUN`` words of which fewer than ``WINDOW`` would be left, which the other form can't find.
    """

    def __init__(self, items: list[tuple[int, str | None]], folded: bool = False) -> None:
        self.ids, self.words, self.places, self.spelt, self.folded = [], [], [], [], folded
        codes = []
        for item, t in items:
            spelt = [w for w in T.unmangle(t or "").split() if _LETTERS.search(w)]
            left = np.array([bool(canonical(w)) for w in spelt], bool)
            if len(spelt) < RUN:
                continue
            if folded:
                runs = np.convolve(left, np.ones(RUN, np.int64), "valid")
                if runs.min() >= WINDOW:
                    continue
            kept = [(i, canonical(w, folded)) for i, w in enumerate(spelt) if canonical(w, folded)]
            if len(kept) >= WINDOW:
                self.ids.append(item)
                self.words.append([w for _, w in kept])
                self.places.append([i for i, _ in kept])  # among all the item's words
                self.spelt.append(spelt)
                codes.append(np.array([zlib.crc32(w.encode()) for w in self.words[-1]], np.uint64))
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.length = np.array([len(c) for c in codes], np.int64)
        self.begin = np.cumsum(self.length) - self.length  # of each item's words in ``codes``
        self.codes = cat(codes, np.uint64)
        h, item, at = [], [], []
        for k, c in enumerate(codes):
            for s in seeds(c):
                h.append(s)
                item.append(np.full(len(s), k, np.int64))
                at.append(np.arange(len(s), dtype=np.int64))
        h, item, at = cat(h, np.uint64), cat(item, np.int64), cat(at, np.int64)
        order = np.argsort(h, kind="stable")
        self.hash, self.item, self.offset = h[order], item[order], at[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.hash >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True


def _without_repeats(c: T.Cues) -> np.ndarray:
    """Positions of words to keep: first lines of a cue (one or more) with which the cue before ended (rolling captions, repeated cues) are dropped.

    So is a line of two words or more that repeats the line before it. A quarter of the repeated words may differ, since copies may be damaged
    each in its own way. Cues without words don't count as cues between.
    """
    n = len(c.code)
    if not n:
        return np.zeros(0, np.int64)
    new_cue, new_doc = np.r_[True, c.cue[1:] != c.cue[:-1]], np.r_[True, c.doc[1:] != c.doc[:-1]]
    new_line = new_cue | np.r_[True, c.line[1:] != c.line[:-1]]
    line_at = np.flatnonzero(new_line)
    line_end = np.r_[line_at[1:], n]
    cue_at = np.flatnonzero(new_cue)
    cue_end = np.r_[cue_at[1:], n]
    first_line = np.searchsorted(line_at, cue_at)
    n_lines = np.r_[first_line[1:], len(line_at)] - first_line
    before = np.r_[0, (cue_end - cue_at)[:-1]]
    before[new_doc[cue_at]] = 0
    keep = np.ones(n, bool)

    def drop(start: np.ndarray, length: np.ndarray) -> None:
        if not len(start):
            return
        first_of = np.cumsum(length) - length
        here = np.repeat(start - first_of, length) + np.arange(length.sum())
        wrong = np.add.reduceat((c.code[here] != c.code[here - np.repeat(length, length)]).astype(np.int64), first_of)
        for i, m in zip(start[wrong <= length // 4].tolist(), length[wrong <= length // 4].tolist(), strict=True):
            keep[i : i + m] = False

    m, may = 1, np.flatnonzero(before > 0)
    while len(may):
        length = line_end[first_line[may] + m - 1] - cue_at[may]
        may, length = may[length <= before[may]], length[length <= before[may]]
        drop(cue_at[may], length)
        m += 1
        may = may[n_lines[may] >= m]
    size = line_end - line_at
    again = np.flatnonzero(np.r_[False, size[1:] == size[:-1]] & (size > 1) & ~new_cue[line_at])
    drop(line_at[again], size[again])
    return np.flatnonzero(keep)


def _rejoined(c: T.Cues, keep: np.ndarray, words: T.Words) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
    """(positions, codes, spellings that differ): words broken by a hyphen at the end of a line are joined with the next word kept, which may be in the next cue."""
    code, line, doc = c.code[keep], c.line[keep], c.doc[keep]
    joined: dict[int, str] = {}
    gone = np.zeros(len(keep), bool)
    for i in np.flatnonzero(line[1:] != line[:-1]).tolist():
        a = c.raw[c.at[keep[i]]]
        if a[-1] in "-\xad" and len(a) > 1 and a[-2].isalpha() and doc[i] == doc[i + 1] and not gone[i]:
            b = c.raw[c.at[keep[i + 1]]]
            if b[0].isalpha():
                joined[i], gone[i + 1] = a[:-1] + b, True
                code[i] = words[joined[i]]
    if not joined:
        return keep, code, {}
    left = np.flatnonzero(~gone)
    new = np.cumsum(~gone) - 1
    return keep[left], code[left], {int(new[i]): w for i, w in joined.items()}


def _pairs(index: Index, texts: list[str | None], words: T.Words, close: dict[tuple[str, str], bool]) -> list[tuple[int, int]]:
    """``_found`` with long markup and sound descriptions as words and, where there are such, without them: they may part a passage or hold one."""
    got = list(_found(index, texts, words, close, long=False))
    again, have = [i for i, t in enumerate(texts) if index.ids and T.has_long(t)], set(got)
    if again:
        got += [(again[d], i) for d, i in _found(index, [texts[i] for i in again], words, close, long=True) if (again[d], i) not in have]
    return got


def _stretches(good: np.ndarray) -> list[tuple[int, int]]:
    """First and last positions of the maximal stretches of true ones."""
    edges = np.flatnonzero(np.diff(np.r_[False, good, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _reach(index: Index, item: int, raw: list[str], dropped: np.ndarray, i: int, j: int, begin: int, end: int) -> int:
    """How many of the item's words in a row the document holds: from the i-th to the j-th of those kept, which stand at ``begin`` and ``end`` in the
    document, and beyond both of the skipped ones that are spelt the same there, accents apart. Repeated words (``dropped``) may stand between."""
    places, spelt = index.places[item], index.spelt[item]
    first, last = places[i], places[j]
    for step, bound in ((-1, places[i - 1] if i else -1), (1, places[j + 1] if j + 1 < len(places) else len(spelt))):
        at, word = (begin, first) if step < 0 else (end, last)
        while True:
            at, word = at + step, word + step
            while 0 <= at < len(raw) and raw[at] != T.DOC and (dropped[at] or not _LETTERS.search(raw[at])):
                at += step
            if word == bound or not 0 <= at < len(raw) or canonical(raw[at], True) != canonical(spelt[word], True):
                break
            first, last = min(first, word), max(last, word)
    return last - first + 1


def _found(index: Index, texts: list[str | None], words: T.Words, close: dict[tuple[str, str], bool], long: bool) -> Iterator[tuple[int, int]]:
    """(text, item) pairs among one batch. ``close`` remembers which spellings are which words."""
    if not len(index.ids):
        return
    c = T.cues(texts, words, sounds=False, long=long, lead=True)
    once = _without_repeats(c)
    dropped = np.zeros(len(c.raw), bool)
    dropped[c.at] = True
    dropped[c.at[once]] = False
    keep, codes, spelling = _rejoined(c, once, words)
    doc, at = c.doc[keep], c.at[keep]
    t = codes.astype(np.uint64)
    span = len(MASKS[0])
    pairs = []
    whole = doc[: max(len(doc) - span + 1, 0)] == doc[span - 1 :]
    for h in seeds(t):
        hit = np.flatnonzero(index.table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] & whole)
        lo, hi = np.searchsorted(index.hash, h[hit], "left"), np.searchsorted(index.hash, h[hit], "right")
        n = hi - lo
        if n.any():
            which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            where = np.repeat(hit, n)
            pairs.append(np.stack([doc[where], index.item[which], where - index.offset[which]], 1))
    if not pairs:
        return
    every = np.unique(np.concatenate(pairs), axis=0)
    every = every[np.argsort(index.length[every[:, 1]], kind="stable")]  # items of like length are laid over documents together
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    done = set()
    k = 0
    while k < len(every):
        size = index.length[every[k : k + CELLS // WINDOW, 1]]
        upto = k + max(1, int(np.searchsorted(size * np.arange(1, len(size) + 1), CELLS, "right")))
        d, item, start = every[k:upto].T
        k = upto
        longest = int(index.length[item].max())
        place = start[:, None] + np.arange(longest)
        inside = (place >= bounds[d][:, None]) & (place < bounds[d + 1][:, None]) & (np.arange(longest) < index.length[item][:, None])
        wanted = index.codes[np.minimum(index.begin[item][:, None] + np.arange(longest), len(index.codes) - 1)]
        same = inside & (t[np.clip(place, 0, len(t) - 1)] == wanted)
        total = np.pad(np.cumsum(same, 1, dtype=np.int32), ((0, 0), (1, 0)))
        dense = total[:, WINDOW:] - total[:, :-WINDOW] >= LEAST  # by the window's first word
        for r in np.flatnonzero(dense.any(1)):
            pair = int(d[r]), int(item[r])
            if pair in done:
                continue
            want, first, good = index.words[pair[1]], int(start[r]), same[r].copy()
            windows = np.flatnonzero(dense[r])
            for j in np.flatnonzero(inside[r] & ~same[r]).tolist():
                if windows[0] <= j < windows[-1] + WINDOW:
                    spelt = spelling.get(first + j) or c.raw[at[first + j]], want[j]
                    if (yes := close.get(spelt)) is None:
                        yes = close[spelt] = _close(canonical(spelt[0], index.folded), spelt[1])
                    good[j] = yes
            for i, j in _stretches(good):
                if _reach(index, pair[1], c.raw, dropped, i, j, int(at[first + i]), int(at[first + j])) >= RUN:
                    done.add(pair)
                    yield pair[0], index.ids[pair[1]]
                    break
        if len(close) > 1_000_000:
            close.clear()


def leaked(documents: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id): documents that hold at least ``RUN`` consecutive words of an item.

    The items are shipped to the workers in blocks of ``block_words`` words or one item, so what is shipped is bounded (about 150 bytes a word) however many there are; each
    block passes over the documents. Documents aren't shuffled, and a repeated document (or a null doc_id) yields its own row.
    Items of fewer than ``RUN`` words can't be found; null and empty texts hold nothing.
    """
    numbered = items.where(F.col("text").isNotNull()).select("item_id", "text").orderBy("item_id", "text")
    out = None
    for part in _blocks(numbered, block_words):
        indexes = [Index(part), Index(part, folded=True)]

        def scan(rows: Iterator[pa.RecordBatch], indexes: list[Index] = indexes) -> Iterator[pa.RecordBatch]:
            plain, folded = ((x, T.Words(f), {}) for x, f in zip(indexes, (code, folded_code), strict=True))
            for b in rows:
                ids = b.column(0)
                for first, texts in T.batches(b.column(1)):
                    got = _pairs(plain[0], texts, *plain[1:])
                    have = set(got)
                    got += [x for x in _pairs(folded[0], texts, *folded[1:]) if x not in have]
                    if got:
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array([first + d for d, _ in got])), pa.array([i for _, i in got], pa.int64())], names=["doc_id", "item_id"])

        got = documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, "doc_id bigint, item_id bigint")
        out = got if out is None else out.unionByName(got)
    if out is None:
        return documents.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint")
    return out


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    """Rows in order, a block at a time; only one block is in memory."""
    part: list[tuple[int, str]] = []
    words = 0
    for r in items.toLocalIterator():
        n = len(r.text.split())
        if part and words + n > block_words:
            yield part
            part, words = [], 0
        part.append((r.item_id, r.text))
        words += n
    if part:
        yield part
