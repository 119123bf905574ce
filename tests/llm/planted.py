"""Subtitle texts into which a passage is planted, damaged and interrupted in the ways that a search must see through; the same seed gives the same texts."""

import random
import re

from tests.llm.test_llm import WORDS, srt

ACCENTED = ["été", "où", "à", "ça", "forêt", "garçon", "fenêtre", "déjà", "élève", "hôtel", "naïve", "über", "Mädchen", "señor", "niño", "ação", "l'été", "d'où", "y", "il", "a", "no", "he", "is"]
NAMES = [f"{a}{b}" for a in ("Vel", "Zor", "Mik", "Tan", "Gua", "Phi") for b in ("mora", "shok", "tivu", "rand", "luna")]
MISREAD = {"l": "1", "o": "0", "e": "c", "rn": "m", "m": "rn", "i": "l", "b": "h", "a": "o", "g": "q", "t": "f"}
SOUNDS = ("[door slams]\n{}", "{}\n(music playing)", "{} [sighs]", "♪ \n{}", "*knock*\n{}")
KINDS = ("plain", "roll2", "roll3", "double", "sound", "break", "blank", "two")


def item(r: random.Random, n: int = 30) -> list[str]:
    return [r.choice(WORDS + ACCENTED * 3 + NAMES) for _ in range(n)]


def _filler(r: random.Random) -> list[str]:
    words = ("plain", "night", "river", "house", "walk", "again", "never", "table", "green", "people", "about", "yesterday")
    return [" ".join(r.choice(words) for _ in range(r.randrange(3, 7))) for _ in range(r.randrange(1, 5))]


def _word(r: random.Random, w: str, damage: float) -> str:
    if r.random() < damage:
        k = r.choice(list(MISREAD))
        w = w.replace(k, MISREAD[k], 1)
    if r.random() < 0.2:
        w += r.choice([",", ".", "!", "?", "...", '"', ";"])
    if r.random() < 0.1:
        w = r.choice(["-", '"', "¿", "«"]) + w if r.random() < 0.5 else w.upper()
    return f"<i>{w}</i>" if r.random() < 0.06 else w


def _broken(r: random.Random, lines: list[str]) -> list[str]:
    """Long words at the ends of lines are parted by a hyphen."""
    out, carry = [], []
    for line in lines:
        ws, carry = [*carry, *line.split()], []
        if r.random() < 0.5 and len(re.sub(r"\W", "", ws[-1])) >= 6 and "<" not in ws[-1]:
            ws[-1], carry = ws[-1][:3] + "-", [ws[-1][3:]]
        out.append(" ".join(ws))
    return out + [" ".join(carry)] * bool(carry)


def cues(r: random.Random, words: list[str], kind: str) -> list[str]:
    damage = r.choice([0, 0, 0.1])
    ws = [_word(r, w, damage) for w in words]
    ws = [w.upper() for w in ws] if r.random() < 0.3 else ws
    lines = []
    while ws:
        k = r.randrange(2, 6)
        lines.append(" ".join(ws[:k]))
        ws = ws[k:]
    if kind in ("roll2", "roll3"):
        k = int(kind[-1])
        return ["\n".join(lines[max(0, j - k + 1) : j + 1]) for j in range(len(lines))]
    if kind == "double":
        return [x for t in lines for x in ([t, t] if r.random() < 0.5 else [t])]
    if kind == "sound":
        return [t if r.random() < 0.6 else r.choice(SOUNDS).format(t) for t in lines]
    if kind == "blank":
        return [x for t in lines for x in ([t, ""] if r.random() < 0.3 else [t])]
    if kind == "two":
        return ["\n".join(lines[j : j + 2]) for j in range(0, len(lines), 2)]
    return _broken(r, lines) if kind == "break" else lines


def text(r: random.Random, words: list[str]) -> str:
    t = srt(_filler(r) + cues(r, words, r.choice(KINDS)) + _filler(r), crlf=r.random() < 0.3)
    if r.random() < 0.15:  # UTF-8 read as a Western code page
        return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in t.encode())
    return t
