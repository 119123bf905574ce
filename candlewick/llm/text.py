"""Words of subtitle texts, many texts at a time.

A batch of texts is cleaned by a few passes of a compiled pattern engine over all of it, split at white space, and its words are
looked up in a cache of the distinct spellings seen; after that all work is on integer arrays. Texts are never cut.
"""

import codecs
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUE, LINE, DOC = "\x01", "\x02", "\x03"
BATCH_BYTES = 4_000_000

_MOJIBAKE = re.compile("[Â-ô][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")


def _c1(e: UnicodeError) -> tuple[bytes, int]:
    """The five bytes that the code page leaves undefined stand for themselves."""
    bad = e.object[e.start : e.end]
    if any(ord(c) > 255 for c in bad):
        raise e
    return bytes(map(ord, bad)), e.end


codecs.register_error("candlewick-c1", _c1)


def _decoded(part: str) -> str:
    try:
        return part.encode("cp1252", "candlewick-c1").decode("utf-8")
    except UnicodeError:
        return part


_HIGH = re.compile("[\u00a1-ÿ]{3}")
_ODD = re.compile("[\u00a1-ÿ]")
_HANGUL, _CYRILLIC = re.compile("[가-힣]"), re.compile("[а-яё]")
# 8-bit encodings of Korean and Russian.
KOREAN, RUSSIAN = ("cp949",), ("cp1251", "koi8-r")
SURE = 6  # odd bytes from which a line shows its encoding although a few don't fit


def _read_as(raw: bytes, encoding: str, share: float) -> str | None:
    """``raw`` in that encoding if at least ``share`` of its high bytes become Hangul or Cyrillic letters."""
    n = sum(b > 127 for b in raw)
    text = raw.decode("euc_kr" if share == 1 and encoding in KOREAN else encoding, "replace")  # of few syllables all are common ones
    made = 2 * len(_HANGUL.findall(text)) if encoding in KOREAN else len(_CYRILLIC.findall(text.lower()))
    return text if n and made >= share * n else None


def _raw(text: str) -> bytes | None:
    """The bytes of a text that nearly all consists of odd letters; None if it doesn't, or if the bytes are UTF-8."""
    if len(_ODD.findall(text)) < 0.4 * sum(map(str.isalpha, text)):
        return None
    try:
        raw = text.encode("cp1252", "candlewick-c1")
    except UnicodeError:
        return None
    try:
        raw.decode("utf-8")
    except UnicodeError:
        return raw
    return None


def _likely(raw: bytes) -> str | None:
    """The encoding, of Korean and Russian ones, in which the bytes make sense; of short lines every byte must. Between Russian ones the more lower-case letters decide."""
    share = 0.8 if sum(b > 127 for b in raw) >= SURE else 1.0
    if _read_as(raw, KOREAN[0], share):
        return KOREAN[0]
    fits = [e for e in RUSSIAN if _read_as(raw, e, share)]
    return max(fits, key=lambda e: len(_CYRILLIC.findall(raw.decode(e, "replace"))), default=None)


def _eastern(text: str) -> str:
    """Lines of Korean or Russian in an 8-bit encoding that were read as a Western code page.

    Three odd letters on end, which Western words don't have, make a line suspect. The encoding that most of such bytes make sense in is tried first on
    all lines, also on those of fewer odd letters; these must make sense whole.
    """
    lines = text.split("\n")
    raws = [_raw(x) if _ODD.search(x) else None for x in lines]
    votes: dict[str, int] = {}
    for x, raw in zip(lines, raws, strict=True):
        if raw is not None and _HIGH.search(x) and (e := _likely(raw)):
            votes[e] = votes.get(e, 0) + len(raw)
    if not votes:
        return text
    most = max(votes, key=votes.__getitem__)
    out = []
    for x, raw in zip(lines, raws, strict=True):
        if raw is not None:
            got = _read_as(raw, most, 0.8 if sum(b > 127 for b in raw) >= SURE else 1.0)
            if got is None and _HIGH.search(x) and (e := _likely(raw)):
                got = raw.decode(e, "replace")
            x = x if got is None else got
        out.append(x)
    return "\n".join(out)


def unmangle(text: str) -> str:
    """Text that was read with a wrong encoding (UTF-8, Korean or Russian as a Western code page) is read again.

    Text that can't have come about so stays as it is.
    """
    if text.isascii():
        return text
    if _HIGH.search(text):
        text = _eastern(text)
    if not _MOJIBAKE.search(text):
        return text
    whole = _decoded(text)
    return whole if whole != text else "\n".join(_decoded(x) if _MOJIBAKE.search(x) else x for x in text.split("\n"))


MARKUP = r"<[^<>\n]{0,80}>|\{[^{}\n]{0,80}\}"
SOUNDS = r"\[[^\[\]\x01\x03]{0,120}\]|\([^()\x01\x03]{0,120}\)|\*[^*\n\x01]{1,120}\*"
#: The same of any length. What is longer may also be text between stray brackets, so tags must look like tags, and a search for words goes by both readings.
LONG_MARKUP = r"<[^<>\n]{0,80}>|<[/!?]?[A-Za-z][^<>\n]*>|\{[^{}\n]*\}"
LONG_SOUNDS = r"\[[^\[\]\x01\x03]*\]|\([^()\x01\x03]*\)|\*[^*\n\x01]+\*"
_LONG = re.compile(r"<[/!?]?[A-Za-z][^<>\n]{80,}>|\{[^{}\n]{81,}\}|\[[^\[\]]{121,}\]|\([^()]{121,}\)|\*[^*\n]{121,}\*")


def has_long(text: str | None) -> bool:
    """Whether the two readings may differ."""
    return bool(text and _LONG.search(text))


#: A cue's time line, with the line before it if that is a number.
TIME_LINE = r"(?m)(?:^\d+[ \t]*\n)?^[^\n]*-->[^\n]*$"


def prepare(texts: list[str | None], sounds: bool, long: bool = True) -> list[str]:
    """White-space separated words of all texts: DOC before each text, CUE for each time line, LINE at each end of line.

    Markup is dropped, if ``long`` of any length. Unless ``sounds``, so are sound descriptions. Null is an empty text.
    """
    clean = [unmangle(t).replace(DOC, " ").replace(CUE, " ").replace(LINE, " ") if t else "" for t in texts]
    a = pa.array([f"\n{DOC}\n".join(["", *clean])], pa.large_string())
    a = pc.replace_substring(pc.replace_substring(a, "\r\n", "\n"), "\r", "\n")
    a = pc.replace_substring_regex(a, pattern=TIME_LINE, replacement=CUE)
    a = pc.replace_substring_regex(a, pattern=LONG_MARKUP if long else MARKUP, replacement="")
    if not sounds:
        a = pc.replace_substring_regex(a, pattern=LONG_SOUNDS if long else SOUNDS, replacement=" ")
    a = pc.replace_substring(pc.replace_substring(a, "\n\n", "\n"), "\n", f" {LINE} ")
    return a[0].as_py().split()


class Words(dict):
    """Codes of spellings, worked out once each. Negative codes are marks and things that aren't words."""

    def __init__(self, code: Callable[[str], int], limit: int = 1_000_000) -> None:
        super().__init__({CUE: -1, LINE: -2, DOC: -3})
        self.code, self.limit = code, limit

    def __missing__(self, raw: str) -> int:
        if len(self) > self.limit:
            self.clear()
            self.update({CUE: -1, LINE: -2, DOC: -3})
        v = self[raw] = self.code(raw)
        return v


NOTHING = -4


@dataclass
class Cues:
    """Words of a batch in order: ``raw`` position, code, text, cue (over the whole batch) and line of each; first cue and number of cues of each text."""

    raw: list[str]
    at: np.ndarray
    code: np.ndarray
    doc: np.ndarray
    cue: np.ndarray
    line: np.ndarray
    first_cue: np.ndarray
    n_cues: np.ndarray


def cues(texts: list[str | None], words: Words, sounds: bool, long: bool = True, lead: bool = False) -> Cues:
    """Splits texts. What stands before a text's first time line, and the number before each time line, belongs to no cue and is dropped;
    a text without time lines is one cue, for which ``n_cues`` is 0. With ``lead``, what stands before the first time line is a cue of its own, the text's first."""
    raw = prepare(texts, sounds, long)
    code = np.fromiter(map(words.__getitem__, raw), np.int64, len(raw))
    doc = np.cumsum(code == -3) - 1
    mark = np.flatnonzero(code == -1)
    n_cues = np.bincount(doc[mark], minlength=len(texts)).astype(np.int64)
    led = ((n_cues > 0) & lead).astype(np.int64)
    first_cue = np.concatenate([[0], np.cumsum(np.maximum(n_cues, 1) + led)[:-1]]) if len(texts) else n_cues
    seen = np.cumsum(code == -1)
    starts = np.flatnonzero(code == -3)
    seen_before = seen[starts] if len(starts) else seen[:0]
    within = seen - seen_before[doc] - 1 if len(code) else seen
    within = np.where(n_cues[doc] == 0, 0, within + led[doc]) if len(code) else within
    line = np.cumsum(code == -2)
    keep = np.flatnonzero((code >= 0) & (within >= 0))
    return Cues(raw, keep, code[keep], doc[keep], first_cue[doc[keep]] + within[keep], line[keep], first_cue, n_cues + led)


def batches(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Slices of a column of texts with their offsets, of about ``BATCH_BYTES``; a longer text is a slice of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    i = 0
    while i < len(sizes):
        total, j = 0, i
        while j < len(sizes) and (j == i or total + sizes[j] <= BATCH_BYTES):
            total += sizes[j]
            j += 1
        yield i, texts.slice(i, j - i).to_pylist()
        i = j
