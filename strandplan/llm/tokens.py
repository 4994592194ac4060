"""Token ids of whole texts, as the library ``tokenizers`` gives them for the lower-casing word-end BPE vocabulary.

Neither normaliser nor merges look across white space, so a text's ids are those of its white-space-separated
chunks, one after the other.  Each distinct chunk is encoded once (by the library's own BPE model) and kept in a
bounded table; texts are then put together from it by array operations.  The table is searched by hash, and what is found
is compared with the chunk byte by byte: a text with a chunk whose hash another one holds goes to the library whole.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import regex

from .common import same_bytes, word_bounds, word_hashes

MAX_ENTRIES = 500_000
"""Distinct chunks a worker keeps at most; beyond that the table is started anew, which costs time but no result."""

LINES_AT_ONCE = 8
"""Lines of 2000 pieces handed to the library at a time; its encodings take some hundred bytes a token."""

_WIDE_SPACE = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")
_SPECIAL = re.compile(r"<\|(?:startoftext|endoftext)\|>")


class ChunkEncoder:
    """encode(texts) -> (ids, row offsets). Whatever a chunk table can't serve goes to the library as a whole text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern)
        self.parts = Tokenizer(self.whole.model)
        self.parts.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = spec["model"]["end_of_word_suffix"]
        size = max(spec["model"]["vocab"].values()) + 1
        self.last = np.zeros(size, bool)
        for token, k in spec["model"]["vocab"].items():
            self.last[k] = token.endswith(suffix)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        self.letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.store = np.zeros(0, np.uint32)
        self.begin = np.zeros(0, np.int64)
        self.end = np.zeros(0, np.int64)
        self.bytes = np.zeros(0, np.uint8)

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        pieces = [self.pieces.findall(c) for c in chunks]
        per_chunk = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = [p for ps in pieces for p in ps]
        found = [np.zeros(0, np.uint32)]
        lines = [" ".join(flat[i : i + 2000]).encode().decode("latin-1").translate(self.letters | {32: " "}) for i in range(0, len(flat), 2000)]
        for i in range(0, len(lines), LINES_AT_ONCE):
            found += [np.array(e.ids, np.uint32) for e in self.parts.encode_batch_fast(lines[i : i + LINES_AT_ONCE], add_special_tokens=False)]
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(flat):
            raise ValueError("the vocabulary does not mark the end of each piece")
        bounds = np.r_[0, ends]
        upto = bounds[np.r_[0, np.cumsum(per_chunk)]]
        return ids, np.diff(upto)

    def _look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, hashes)
        return at, (at < len(self.keys)) & (self.keys[np.minimum(at, max(len(self.keys) - 1, 0))] == hashes) if len(self.keys) else np.zeros(len(hashes), bool)

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        ids, counts = self._encode_chunks([c.decode("utf-8", "surrogatepass") for c in chunks])
        at = len(self.store) + np.cumsum(counts) - counts
        self.store = np.concatenate([self.store, ids])
        end = len(self.bytes) + np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        begin = np.r_[len(self.bytes), end][:-1]
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(chunks), np.uint8)])
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.at, self.counts, self.begin, self.end = (np.concatenate(c)[order] for c in ((self.at, at), (self.counts, counts), (self.begin, begin), (self.end, end)))

    def normal(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = _WIDE_SPACE.sub(" ", text).replace("Σ", "σ")
        return text.lower()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = {i for i, t in enumerate(texts) if "<|" in t and _SPECIAL.search(t)}
        blobs = [self.normal(t).encode("utf-8", "surrogatepass") for t in texts]
        for i in special:
            blobs[i] = b""
        data = np.frombuffer(b"".join(blobs), np.uint8)
        offs = np.r_[0, np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)))]
        starts, ends, first = word_bounds(data, offs)
        uniq, some, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at, known = self._look_up(uniq)
        if not known.all():
            new = some[~known]
            missing = uniq[~known]
            if len(self.keys) + len(missing) > MAX_ENTRIES:  # then all that this round needs is learnt again
                missing, new = uniq, some
                self._reset()
            raw = data.tobytes()
            self._learn(missing, [raw[s:e] for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            at, _ = self._look_up(uniq)
        entry = at[inverse]
        served = same_bytes(data, starts, ends, self.bytes, self.begin[entry], self.end[entry])
        special |= set((np.searchsorted(first, np.flatnonzero(~served), "right") - 1).tolist())
        counts, begin = self.counts[entry], self.at[entry]
        upto = np.r_[0, np.cumsum(counts)]
        ids = self.store[np.repeat(begin - upto[:-1], counts) + np.arange(upto[-1])]
        rows = upto[first]
        if special:
            cut = [ids[rows[i] : rows[i + 1]] for i in range(len(texts))]
            for i in special:
                cut[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            rows = np.r_[0, np.cumsum([len(c) for c in cut])]
            ids = np.concatenate(cut)
        return ids.astype(np.uint32, copy=False), rows


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One for each worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
