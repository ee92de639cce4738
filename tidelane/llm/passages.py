"""Passages of texts in a form that disguises don't change, and their n-grams as numbers."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

#: Letters of other scripts that look like Latin ones.
LOOKALIKE = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
#: Signs that stand for letters inside a word.
SIGN = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "€": "e", "|": "i"}

#: Names of markup, which say nothing; those of the first line stand inside words and sentences.
INLINE = "b i u s em strong span font mark small big sub sup"
BLOCK = "p br hr div ul ol li h1 h2 h3 h4 h5 h6 table tr td th thead tbody pre code a img html body head title script style section article header footer blockquote"
_INLINE = re.compile(rf"</?(?:{INLINE.replace(' ', '|')})\s*/?>", re.IGNORECASE)
#: Ends of lines and sentences (also glued ones), and brackets of markup: names of markup go, whatever else is between brackets stays.
_SPLIT = re.compile(
    r"[\r\n\u2028\u2029]+|(?<=[.!?;:])\s+|(?<=[a-z]{3}[.!?;])(?=[A-Z\u2e80-\uffff])|(?<=[。！？；])"
    rf"|</?(?i:{INLINE.replace(' ', '|')}|{BLOCK.replace(' ', '|')})(?=[\s/>])|[<>]",
)
#: A sign between letters, or at the start of a word of at least four signs and letters.
_SIGNED = re.compile(r"[a-z][0134 57@$€|]+[a-z]|^\W*[0134 57@$€|][a-z]{3}".replace(" ", ""))
_WORD = re.compile(r"\S+")
_OTHER = re.compile(r"[\W\d_]+")
_REPEAT = re.compile(r"([^\W\d_])\1+")
_LOOK = str.maketrans(LOOKALIKE)
_SIGN = str.maketrans(SIGN)
_SIGNS = frozenset(SIGN)
#: Combining marks that a decomposed letter carries.
_MARKS = re.compile(r"[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ufe20-\ufe2f]+")

LATIN_GRAM = 4
WIDE_GRAM = 2
#: Letters of a passage beyond which it is divided; the parts overlap so that no phrase of half that length is cut.
LONGEST = 240


def _word(m: re.Match) -> str:
    """Signs that stand for letters inside a word become letters; numbers, units and numbered names stay."""
    word = m.group()
    return word.translate(_SIGN) if _SIGNED.search(word) else word


def squash(passage: str) -> str:
    """Lower-case letters only: no blanks, marks or digits, lookalikes as Latin, each letter once in a row."""
    plain = passage.isascii()
    text = passage.lower() if plain else unicodedata.normalize("NFKC", passage).lower().translate(_LOOK)
    if not _SIGNS.isdisjoint(text):
        text = _WORD.sub(_word, text)
    if not plain:
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return _REPEAT.sub(r"\1", _OTHER.sub("", text))


def passages(text: str | None) -> list[str]:
    """The squashed passages of a whole text, empty ones left out; a very long one as overlapping parts.

    Markup divides a text (inside a sentence it vanishes); only the names of tags are left out, so what stands in
    an attribute, in brackets or in a comparison is read.
    """
    out = []
    text = text or ""
    if "<" in text:
        text = _INLINE.sub("", text)
    for piece in _SPLIT.split(text):
        s = squash(piece) if piece else ""
        if len(s) <= LONGEST:
            if s:
                out.append(s)
        else:
            out += [s[i : i + LONGEST] for i in range(0, len(s) - LONGEST // 2, LONGEST // 2)]
    return out


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams (uint64) of squashed texts and the text each is from.

    Four letters, or two of a script with large alphabets; a text shorter than a gram is one gram.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.repeat(lengths, lengths) - place
    wide = codes >= 0x2E80
    size = np.where(wide, WIDE_GRAM, LATIN_GRAM)
    size = np.minimum(size, np.repeat(lengths, lengths))
    keep = left >= size
    mixed = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(LATIN_GRAM):
            ahead = np.zeros(len(codes), np.uint64)
            if i < len(codes):
                ahead[: len(codes) - i] = codes[i:]
            mixed = np.where(i < size, mixed * np.uint64(0x9E3779B97F4A7C15) + (ahead + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F), mixed)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return mixed[keep], owner[keep]
