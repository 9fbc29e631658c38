"""Token ids of whole texts through the tokenizers library, words encoded once.

Both tokenizers used here never form a token across a space that a visible character follows. So a text is cut
there, distinct words of a batch are looked up in a cache, and only new ones go through the library, many in one
string. Neither joins a letter or digit with a mark after it, nor a single line end with what comes next; texts are cut
there too, so that a word is learnt once and not again with every mark beside it. Where a word begins or ends is seen
from its tokens; words whose tokens don't show it are kept apart by a special token, which ends every segment. Texts whose
spaces don't allow the cut, and words that hold the special token themselves, are encoded by the library as they are. The
cache lives in the Python worker, is bounded, and starts anew when full; results don't depend on it.
"""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words that a worker remembers at most.
CACHE_WORDS = 1_000_000
#: Bytes of text handled at once.
BATCH_BYTES = 6_000_000
WORDS_PER_STRING = 1000
#: A space before white space, at the end, or NUL: such a text isn't cut. White space as the tokenizer's pattern has it.
_UNSAFE = " [\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]| $|\\x00"
#: Bytes after which a mark begins a token: ASCII letters and digits; and those that lead a letter of two bytes (U+00C0 to
#: U+027F and U+0400 to U+047F, where only the signs of multiplication and division are none; U+0130 is left out, as its
#: lower case ends in a combining dot).
_PLAIN, _LEAD, _SHOWN = (np.isin(np.arange(256), list(some)) for some in (
    b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", b"\xc3\xc4\xc5\xc6\xc7\xc8\xc9\xd0\xd1", range(0x21, 0x7F)))

_ENCODERS: dict[tuple[str, str, bool], TextEncoder] = {}


def encoder(path: str, separator: str, leading_space: bool) -> TextEncoder:
    """This worker's encoder for a tokenizer file."""
    key = (path, separator, leading_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(*key)
    return _ENCODERS[key]


class TextEncoder:
    """`separator`: a special token of the vocabulary. `leading_space`: whether a word's space belongs to its tokens."""

    def __init__(self, path: str, separator: str, leading_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator, self.separator_id, self.leading_space = separator, self.tokenizer.token_to_id(separator), leading_space
        size = self.tokenizer.get_vocab_size()
        shown = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.edge = np.array([t.startswith("\u0120") if leading_space else t.endswith("</w>") for t in shown])
        # a mark of an added token never begins a piece, as that token has to stay whole
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values()).encode()
        self.marks = _SHOWN & ~_PLAIN & ~np.isin(np.arange(256), list(added))
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = _id_lists(np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of each text's ids. Null is empty."""
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        parts, at = [], 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_BYTES)))
            parts.append(self._batch(texts.slice(at, upto - at)))
            at = upto
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.leading_space:
            return self._coded(*self._pieces(texts))
        unsafe = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        if not unsafe.any():
            return self._coded(*self._pieces(texts))
        whole = self.plain(texts.filter(pa.array(unsafe)).to_pylist())
        rest = texts.filter(pa.array(~unsafe))
        ids, counts = self._coded(*self._pieces(rest))
        ends = np.cumsum(counts)
        others, wholes, found = iter([ids[e - c : e] for e, c in zip(ends, counts, strict=True)]), iter(whole), []
        for odd in unsafe:
            found.append(next(wholes if odd else others))
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The texts cut before spaces, before marks after a letter or digit, and after single line ends; how many pieces there are up to each text's end."""
        texts = texts.cast(pa.large_string())
        _, places, data = texts.buffers()
        starts = np.frombuffer(places, np.int64, len(texts) + 1, 8 * texts.offset)
        first, size = int(starts[0]), int(starts[-1] - starts[0])
        raw = np.frombuffer(data or b"", np.uint8, size, first)
        begins = np.empty(size + 1, bool)
        np.equal(raw, 0x20, out=begins[:size])
        marks = np.flatnonzero(self.marks[raw[1:]]) + 1
        last, lead = raw[marks - 1], raw[np.maximum(marks - 2, 0)]
        letter = (last & 0xC0 == 0x80) & _LEAD[lead] & ~((lead == 0xC3) & (last & 0xDF == 0x97)) & ~((lead == 0xC4) & (last == 0xB0))
        begins[marks[_PLAIN[last] | letter]] = True
        lines = np.flatnonzero(raw[1:-1] == 0x0A) + 2
        begins[lines[_SHOWN[raw[lines]] & _SHOWN[raw[lines - 2]]]] = True
        begins[starts - first] = True
        bounds = np.flatnonzero(begins)
        pieces = pa.Array.from_buffers(pa.large_string(), bounds.size - 1, [None, pa.py_buffer(bounds + first), data])
        return pieces, np.searchsorted(bounds, starts[1:] - first)

    def _coded(self, words: pa.Array, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each text has, whose words end before the given places."""
        if len(self.slots) > CACHE_WORDS:
            self._forget()
        words = words.dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = np.fromiter(map(self.slots.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(slots < 0)
        if new.size:
            slots[new] = self._learn([distinct[i] for i in new])
        found = self.ids.take(pa.array(slots).take(words.indices))
        ends = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1) // 4
        return np.frombuffer(found.buffers()[2] or b"", np.uint32, int(ends[-1])), np.diff(ends[upto], prepend=0)

    def _learn(self, words: list[str]) -> np.ndarray:
        """Slots of new words. Most go through the library as one running text whose tokens tell where a word begins or ends."""
        simple, others, odd = [], [], []
        for i, word in enumerate(words):
            if self.separator in word:
                odd.append(i)
            elif (word[:1] == " ") if self.leading_space else word.lstrip(" ").lower().isalpha():
                simple.append(i)
            else:
                others.append(i)
        ids, lengths = self._running([words[i] for i in simple])
        if lengths is None:
            others, simple, lengths = others + simple, [], np.zeros(0, np.int64)
        more, more_lengths = self._separated([words[i] for i in others])
        single = self.plain([words[i] for i in odd])
        made = _id_lists(np.concatenate([ids, more, *single]), np.concatenate([lengths, more_lengths, np.array([len(s) for s in single], np.int64)]))
        slots = np.empty(len(words), np.int64)
        slots[np.array(simple + others + odd, np.int64)] = np.arange(len(self.slots), len(self.slots) + len(words))
        self.ids = pa.concat_arrays([self.ids, made])
        self.slots.update(zip(words, slots.tolist(), strict=True))
        return slots

    def _joined(self, words: list[str], between: str) -> np.ndarray:
        strings = [between.join(words[i : i + WORDS_PER_STRING]) + between for i in range(0, len(words), WORDS_PER_STRING)]
        return np.concatenate([*self.plain(strings), np.zeros(0, np.uint32)])

    def _running(self, words: list[str]) -> tuple[np.ndarray, np.ndarray | None]:
        """Words with their space begin with a token that has it; words of letters alone end with one that ends a word."""
        ids = self._joined(words, "" if self.leading_space else " ")
        edges = np.flatnonzero(self.edge[ids])
        if edges.size != len(words):
            return np.zeros(0, np.uint32), None
        return ids, np.diff(edges, append=ids.size) if self.leading_space else np.diff(edges, prepend=-1)

    def _separated(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._joined(words, self.separator)
        stops = np.flatnonzero(ids == self.separator_id)
        if stops.size != len(words):
            raise ValueError(f"{stops.size} segments for {len(words)} words")
        return ids[ids != self.separator_id], np.diff(stops, prepend=-1) - 1


def _id_lists(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Lists of ids as binary cells, which Arrow copies as a whole."""
    places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * 4
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(places), pa.py_buffer(ids.astype(np.uint32))])


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids followed by one more id; and the counts with it."""
    more = counts + 1
    out = np.empty(int(more.sum()), np.uint32)
    last = np.cumsum(more) - 1
    is_end = np.zeros(out.size, bool)
    is_end[last] = True
    out[is_end], out[~is_end] = end_id, ids
    return out, more
