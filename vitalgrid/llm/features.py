"""Term counts of texts for the classifiers: byte-class pairs and hashed words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from vitalgrid.llm.lm_scoring import tokenize

PAIR_TERMS = 64 * 64
SHAPE_TERMS = 32


def _classes() -> np.ndarray:
    """64 classes of bytes: 26 letters, capitals by thirds, digits, blanks, ASCII marks, non-ASCII by eighths."""
    out = np.zeros(256, np.int64)
    for b in range(256):
        if 97 <= b < 123:
            out[b] = b - 97
        elif 65 <= b < 91:
            out[b] = 26 + (b - 65) // 9
        elif 48 <= b < 58:
            out[b] = 29
        elif b == 10:
            out[b] = 30
        elif b <= 32:
            out[b] = 31
        elif b >= 128:
            out[b] = 56 + (b - 128) // 16
        else:
            out[b] = 32 + [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 128)].index(b) % 24
    return out


CLASSES = _classes()


def pair_counts(texts: list[str]) -> np.ndarray:
    """Rows of byte-class pair counts followed by shape terms (repetition of lines, words and word pairs)."""
    out = np.zeros((len(texts), PAIR_TERMS + SHAPE_TERMS), np.float32)
    for row, t in zip(out, texts, strict=True):
        raw = t.encode()
        if len(raw) > 1:
            c = CLASSES[np.frombuffer(raw, np.uint8)]
            row[:PAIR_TERMS] = np.bincount(c[:-1] * 64 + c[1:], minlength=PAIR_TERMS)
        lines = [x for x in t.split("\n") if x.strip()]
        words = raw.lower().split()
        shares = (
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            1 - len(set(words)) / len(words) if words else 0.0,
            1 - len(set(zip(words, words[1:]))) / max(1, len(words) - 1),
            1 - len(set(zip(words, words[1:], words[2:]))) / max(1, len(words) - 2),
        )
        for f, share in enumerate(shares):
            row[PAIR_TERMS + 5 * f + min(4, int(share * 5))] = 4 + len(words) ** 0.5
        row[PAIR_TERMS + 20 + min(11, int(np.log2(len(words) + 1)))] = 4 + len(words) ** 0.5
    return out


def word_counts(texts: pa.Array, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse hashed word counts: document, term, count; and the words of each text.

    Words are lower-cased and stripped of ASCII marks at both ends.
    """
    ids, size, names = tokenize(texts)
    term_of = np.array([xxhash.xxh3_64_intdigest(w.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")) % terms for w in names] or [0], np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    key, count = np.unique(doc * terms + term_of[ids] if len(ids) else np.zeros(0, np.int64), return_counts=True)
    return key // terms, key % terms, count, size


def as_texts(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "")
