"""Token ids of whole texts by a tokenizer file of the `tokenizers` library.

The ids of a text are those of `Tokenizer.encode(text, add_special_tokens=False)`. For byte-level
BPE files without a normaliser a text is the sum of its parts at single spaces: the library encodes
every distinct part once, and its ids are kept in a table of bounded size per Python worker, found
by a 64-bit hash of the part and used only if the part's bytes are those of the entry. A text with a
part that is not, or with the string of an added token, is encoded as it stands; so is each text
under other files.
"""

from __future__ import annotations

import json
import os

import numpy as np

from sluice.llm.hashing import BYTES, running, stretches

#: Distinct parts kept per worker, and their bytes. When there are more, the table starts anew.
PARTS, PART_BYTES = 2_000_000, 64 << 20
#: Bytes handled at once.
BLOCK = 250_000
#: Set apart the parts at the start of a text, which have no space before them.
_HEAD = np.uint64(0x5851F42D4C957F2D)

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one per process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Table:
    """Parts and their runs of ids by 64-bit keys: open addressing in numpy arrays."""

    def __init__(self, dtype: np.dtype) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.bits, self.n, self.used = 16, 0, 0
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.zeros(1 << self.bits, np.int32)
        self.count = np.zeros(1 << self.bits, np.int32)
        self.part_at = np.zeros(1 << self.bits, np.int32)
        self.part_size = np.zeros(1 << self.bits, np.int32)
        self.ids = np.zeros(1 << 18, self.dtype)
        self.parts, self.part_bytes = np.zeros(1 << 18, np.uint8), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int64)
        mask = len(self.keys) - 1
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        which = np.arange(len(keys))
        while len(which):
            there = self.keys[slots]
            wanted = keys[which]
            hit = there == wanted
            out[which[hit]] = slots[hit]
            on = np.flatnonzero(~hit & (there != 0))
            which, slots = which[on], slots[on] + 1 & mask
        return out

    def same(self, slots: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the part in each slot is the bytes of `data` from start to end."""
        sizes = ends - starts
        out = self.part_size[slots] == sizes
        slots, starts, sizes = slots[out], starts[out], sizes[out]
        total = np.cumsum(sizes)
        within = np.arange(total[-1] if len(total) else 0) - np.repeat(total - sizes, sizes)
        differ = self.parts[np.repeat(self.part_at[slots], sizes) + within] != data[np.repeat(starts, sizes) + within]
        if differ.any():
            wrong = np.searchsorted(total, np.flatnonzero(differ), "right")
            out[np.flatnonzero(out)[wrong]] = False
        return out

    def put(self, keys: np.ndarray, parts: list[bytes], runs: list[bytes], counts: np.ndarray) -> None:
        """New, distinct keys. A count of -1 stands for a part that has no ids of its own."""
        while 2 * (self.n + len(keys)) > len(self.keys):
            self._grow()
        raw = np.frombuffer(b"".join(runs), self.dtype)
        if self.used + len(raw) > len(self.ids):
            more = max(len(self.ids), len(raw))
            self.ids = np.concatenate([self.ids, np.zeros(more, self.dtype)])
        self.ids[self.used : self.used + len(raw)] = raw
        text = np.frombuffer(b"".join(parts), np.uint8)
        if self.part_bytes + len(text) > len(self.parts):
            self.parts = np.concatenate([self.parts, np.zeros(max(len(self.parts), len(text)), np.uint8)])
        self.parts[self.part_bytes : self.part_bytes + len(text)] = text
        sizes, lengths = np.maximum(counts, 0), np.array([len(part) for part in parts], np.int64)
        begin = self.part_bytes + np.cumsum(lengths) - lengths
        self._place(keys, self.used + np.cumsum(sizes) - sizes, counts, begin, lengths)
        self.used += len(raw)
        self.part_bytes += len(text)
        self.n += len(keys)

    def _place(
        self, keys: np.ndarray, at: np.ndarray, counts: np.ndarray, part_at: np.ndarray, size: np.ndarray
    ) -> None:
        mask = len(self.keys) - 1
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        which = np.arange(len(keys))
        while len(which):
            free = np.flatnonzero(self.keys[slots] == 0)
            self.keys[slots[free]] = keys[which[free]]  # of several for one slot, one stays
            won = self.keys[slots] == keys[which]
            mine, here = which[won], slots[won]
            self.at[here], self.count[here] = at[mine], counts[mine]
            self.part_at[here], self.part_size[here] = part_at[mine], size[mine]
            which, slots = which[~won], slots[~won] + 1 & mask

    def _grow(self) -> None:
        full = np.flatnonzero(self.keys)
        held = [x[full] for x in (self.keys, self.at, self.count, self.part_at, self.part_size)]
        self.bits += 1
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at, self.count, self.part_at, self.part_size = (np.zeros(1 << self.bits, np.int32) for _ in range(4))
        self._place(*held)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        #: Ids are held as little-endian unsigned integers of this many bytes.
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.by_parts = self._splits_at_spaces(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.first = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.first[i] = token.startswith("Ġ")
        self.table = Table(self.dtype)

    def _splits_at_spaces(self, path: str) -> bool:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splitter = spec.get("pre_tokenizer") or {}
        return (
            spec.get("normalizer") is None
            and spec.get("truncation") is None
            and splitter.get("type") == "ByteLevel"
            and bool(splitter.get("use_regex", True))
            and not splitter.get("add_prefix_space")
            and all(token.get("special") for token in spec.get("added_tokens", []))
            and not any(c.isspace() for token in spec.get("added_tokens", []) for c in token["content"])
            and spec["model"].get("type") == "BPE"
            and not spec["model"].get("dropout")
        )

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def ids(self, text: str | None) -> bytes:
        """The ids of one text, `width` bytes each. A null text has the ids of the empty one."""
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_parts:
            return [self.whole(text) if text else b"" for text in texts]
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, bytes, bool]] = []
        held = 0
        for i, text in enumerate(texts):
            if text and any(token in text for token in self.added):
                out[i].append(self.whole(text))
                continue
            for piece, is_head in _pieces((text or "").encode()):
                waiting.append((i, piece, is_head))
                held += len(piece)
                if held >= BLOCK:
                    self._block(waiting, out)
                    waiting, held = [], 0
        if waiting:
            self._block(waiting, out)
        return [runs[0] if len(runs) == 1 else b"".join(runs) for runs in out]

    def _block(self, pieces: list[tuple[int, bytes, bool]], out: list[list[bytes]]) -> None:
        data = np.frombuffer(b" ".join([piece for _, piece, _ in pieces]) + b" ", np.uint8)
        ends = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], ends[:-1] + 1])
        keys = stretches(running(data, BYTES), starts, ends)
        begin = np.cumsum([0] + [len(piece) + 1 for _, piece, _ in pieces])
        first = np.searchsorted(starts, begin[:-1])
        heads = first[[is_head for _, _, is_head in pieces]]
        keys[heads] ^= _HEAD
        keys[keys == 0] = 1
        slots = self.table.find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            self._learn(data, starts, ends, keys, missing, heads)
            slots[missing] = self.table.find(keys[missing])
        counts = np.where(self.table.same(slots, data, starts, ends), self.table.count[slots], -1)
        unsafe = np.logical_or.reduceat(counts < 0, first)
        sizes = np.maximum(counts, 0)
        total = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.table.at[slots] - total[:-1], sizes) + np.arange(total[-1])
        raw = self.table.ids[places].tobytes()
        cuts = (total[np.append(first, len(starts))] * self.width).tolist()
        for j, (i, piece, is_head) in enumerate(pieces):
            if unsafe[j]:
                text = piece.decode()
                out[i].append(self.whole(text if is_head else " " + text) if text or not is_head else b"")
            else:
                out[i].append(raw[cuts[j] : cuts[j + 1]])
        if self.table.n > PARTS or self.table.part_bytes > PART_BYTES:
            self.table.clear()

    def _learn(self, data, starts, ends, keys, missing, heads) -> None:
        new, at = np.unique(keys[missing], return_index=True)
        at = missing[at]
        is_head = np.zeros(len(starts), bool)
        is_head[heads] = True
        raw = data.tobytes()
        parts = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        words = [part.decode() for part in parts]
        runs: list[bytes | None] = [None] * len(words)
        plain = []
        for j, (word, head) in enumerate(zip(words, is_head[at].tolist())):
            if head:
                # the empty text has no ids; a head that ends in white space may join what follows
                if not word or not word[-1].isspace():
                    runs[j] = self.whole(word) if word else b""
            elif word and not word[0].isspace() and not word[-1].isspace():
                plain.append(j)
        for j, run in zip(plain, self._encode([words[j] for j in plain])):
            runs[j] = run
        counts = np.array([-1 if run is None else len(run) // self.width for run in runs], np.int32)
        self.table.put(new, parts, [run or b"" for run in runs], counts)

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of ' word' for words that touch no white space.

        Put together with single spaces they are encoded as one text: only the first token of
        each word starts with the sign of the space.
        """
        if not words:
            return []
        encoded = self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, self.dtype)
        at = np.flatnonzero(self.first[ids])
        if len(at) != len(words) or at[0]:
            return [self.whole(" " + word) for word in words]
        raw, starts = ids.tobytes(), (at * self.width).tolist()
        return [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]


def _pieces(data: bytes) -> list[tuple[bytes, bool]]:
    """A long text cut at spaces between words, each cut space left out; and which piece is first."""
    if len(data) <= 2 * BLOCK:
        return [(data, True)]
    out, start = [], 0
    while len(data) - start > 2 * BLOCK:
        cut = data.find(b" ", start + BLOCK)
        while cut >= 0 and not (33 <= data[cut - 1] < 127 and cut + 1 < len(data) and 33 <= data[cut + 1] < 127):
            cut = data.find(b" ", cut + 1)
        if cut < 0:
            break
        out.append((data[start:cut], start == 0))
        start = cut + 1
    return [*out, (data[start:], start == 0)]
