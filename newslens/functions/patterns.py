"""Which of many patterns stand in which texts of a whole batch, as array operations.

Each pattern is looked for by one stretch of its bytes, its anchor. All stretches of the batch of the same widths are rolled over the bytes, tested
against a bit map of the anchors, looked up in their sorted list, and what is left is compared in full, eight bytes at a time. So the
cost is the bytes of the texts, not texts times patterns. The anchor of a pattern is its rarest stretch, as counted in a sample: a pattern's
beginning is often the beginning of many words, its rarest part hardly ever leads to a comparison in vain. The sample decides speed only.

Patterns and texts are UTF-8. A pattern's bytes stand in a text's bytes exactly where its characters stand in the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Widths of anchors in bytes; a pattern takes the widest that fits it.
WIDTHS = (8, 6, 4, 3, 2, 1)
SLOT_BITS = 20
#: Bytes of a batch that are looked at in one step, and bytes of the sample.
STEP, SAMPLE = 1 << 20, 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - SLOT_BITS)


def _windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; behind the end come zeros. A view: it takes no memory of its own."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data), "<u8", padded, strides=(1,))


def _mask(width: np.ndarray | int) -> np.ndarray:
    return np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * np.asarray(width).astype(np.uint64))


def _slots(grams: np.ndarray) -> np.ndarray:
    return ((grams * _ODD) >> _SHIFT).astype(np.int64)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, … of all (start, count), one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


class Patterns:
    """Different patterns, none of them empty, as bytes."""

    def __init__(self, patterns: list[bytes]):
        self.lengths = np.array([len(p) for p in patterns], np.int64)
        self.bytes = np.frombuffer(b"".join(patterns), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        fitting = np.array(WIDTHS)[None, :] <= self.lengths[:, None]
        self.widths = np.array(WIDTHS)[fitting.argmax(axis=1)] if len(patterns) else np.zeros(0, np.int64)
        self.tables: list[tuple] = []

    def anchored(self, sample: np.ndarray) -> "Patterns":
        """Choose the anchors by how often their bytes stand in ``sample`` and in the patterns themselves."""
        self.tables = []
        seen, own = _windows(sample[:SAMPLE]), _windows(self.bytes)
        for width in WIDTHS:
            at = np.flatnonzero(self.widths == width)
            if not len(at):
                continue
            counts = np.bincount(_slots(seen & _mask(width)), minlength=1 << SLOT_BITS)
            choices = self.lengths[at] - width + 1
            pattern = np.repeat(at, choices)
            places = spread(self.starts[at], choices)
            grams = own[places] & _mask(width)
            _, number, holders = np.unique(grams, return_inverse=True, return_counts=True)
            cost = (counts[_slots(grams)] + 1) * holders[number]
            order = np.lexsort((cost, pattern))
            first = order[np.concatenate([[True], np.diff(pattern[order]) != 0])]
            offsets, grams = (places - self.starts[pattern])[first], grams[first]
            by_gram = np.argsort(grams, kind="stable")
            anchors, begins, sizes = np.unique(grams[by_gram], return_index=True, return_counts=True)
            bits = np.zeros(1 << SLOT_BITS, bool)
            bits[_slots(anchors)] = True
            self.tables.append((width, bits, anchors, begins, sizes, pattern[first][by_gram], offsets[by_gram]))
        return self

    def found(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, pattern) of all patterns that stand in the texts ``data[offsets[k] : offsets[k + 1]]``, each once, in order."""
        windows, own = _windows(data), _windows(self.bytes)
        parts = [np.zeros(0, np.int64)]
        for step in range(int(offsets[0]), int(offsets[-1]), STEP):
            grams = windows[step : min(step + STEP, int(offsets[-1]))].copy()
            for width, bits, anchors, begins, sizes, patterns, shifts in self.tables:
                short = grams & _mask(width)
                at = np.flatnonzero(bits[_slots(short)])
                place = np.minimum(np.searchsorted(anchors, short[at]), len(anchors) - 1)
                same = anchors[place] == short[at]
                at, place = at[same] + step, place[same]
                which = spread(begins[place], sizes[place])
                at = np.repeat(at, sizes[place])
                pattern, start = patterns[which], at - shifts[which]
                text = np.searchsorted(offsets, at, side="right") - 1
                inside = (start >= offsets[text]) & (start + self.lengths[pattern] <= offsets[text + 1])
                text, pattern, start = text[inside], pattern[inside], start[inside]
                eight = 0
                while len(text):  # eight bytes more of all that are left; who is through is found
                    left = self.lengths[pattern] - eight
                    differ = (windows[start + eight] ^ own[self.starts[pattern] + eight]) & _mask(np.minimum(left, 8))
                    equal = differ == 0
                    through = equal & (left <= 8)
                    parts.append(np.unique(text[through] * len(self.lengths) + pattern[through]))
                    on = equal & (left > 8)
                    text, pattern, start = text[on], pattern[on], start[on]
                    eight += 8
        pairs = np.unique(np.concatenate(parts))
        return pairs // max(1, len(self.lengths)), pairs % max(1, len(self.lengths))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow array of texts; a null has no bytes."""
    texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[: int(offsets[-1])], offsets
