"""Token ids of many texts at once, for tokenizers that cut words before they merge.

A block of texts is cut into pieces: runs of letters, single digits and runs of punctuation,
found as arrays. Such a piece is what the tokenizer's own rule makes of it, so it is encoded
alone, once, and kept; the ids of a text are gathered from those of its pieces. Words in which the
rule may cut elsewhere (apostrophes, characters beyond Latin letters, marks of special
tokens) are encoded whole and kept as well. Whether the short cut holds for a tokenizer is read
from its file; any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

# Classes of bytes. A word with an ODD byte is encoded whole.
BLANK, LETTER, DIGIT, MARK, ODD = range(5)
#: Of the two-byte characters only U+00C0 to U+023F are taken for letters (first bytes C3 to C8);
#: the signs at U+00D7 and U+00F7 and the dotted I, which is two characters in lower case, are not.
LATIN = (0xC3, 0xC8)
NOT_LATIN = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))
#: The rule that this module knows: lower case, contractions, letters, single digits, the rest.
KNOWN_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Pieces a worker's encoder keeps. There is no end of pieces that come once, so a worker reaches any
#: number and then learns the frequent ones anew: 32,000 documents take it 10 % longer at this one
#: than at a million, and 303 MB instead of 437.
PIECES = 250_000
#: Bytes of text a worker encodes at once beside other stages: 30,000 documents take it 6 % longer than in
#: blocks of 2 MB, and 188 MB instead of 275.
BLOCK = 512 << 10


def _classes() -> np.ndarray:
    kinds = np.full(256, ODD, dtype=np.uint8)
    for byte in range(33, 127):
        letter, digit = chr(byte).isalpha(), chr(byte).isdigit()
        kinds[byte] = LETTER if letter else DIGIT if digit else MARK
    kinds[list(b"\t\n\x0b\x0c\r ")] = BLANK
    kinds[ord("'")] = ODD
    kinds[LATIN[0]:LATIN[1] + 1] = LETTER
    kinds[0x80:0xC0] = LETTER  # later bytes of a character; a first byte that is odd decides
    return kinds


_KINDS = _classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Numbers of all elements of the runs, run by run."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - shift, lengths)


class Encoder:
    """Ids of texts; keeps those of up to ``most`` pieces."""

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        split = json.dumps(rules.get("pre_tokenizer") or {}, ensure_ascii=False)
        model = rules["model"]
        suffix = model.get("end_of_word_suffix")
        self.by_piece = (
            json.dumps(KNOWN_RULE, ensure_ascii=False) in split and bool(suffix)
            and '"add_prefix_space": false' in split and not rules.get("post_processor")
            and all("<|" in x["content"] for x in rules.get("added_tokens", []))
            and [x["type"] for x in (rules.get("normalizer") or {}).get("normalizers", [])]
            == ["NFC", "Replace", "Lowercase"])
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        if self.by_piece:
            # Pieces are cut already: their own tokenizer only lowers them and merges.
            steps = rules["pre_tokenizer"]["pretokenizers"]
            self.merges = Tokenizer.from_str(json.dumps(rules | {
                "normalizer": {"type": "Lowercase"},
                "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
                    {"type": "WhitespaceSplit"}, *steps[1:]]}}))
            for token, number in model["vocab"].items():
                self.last[number] = token.endswith(suffix)
        self._clear()

    def _clear(self) -> None:
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.place: dict[bytes, int] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _add(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        base = len(self.starts)
        self.place.update(zip(pieces, range(base, base + len(pieces)), strict=True))
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, ends - starts])
        self.ids = np.concatenate([self.ids, ids])

    def _learn(self, pieces: list[bytes]) -> None:
        """Encodes new pieces, many in a call; each ends with the only id that ends a word."""
        found = [self.ids[:0]]
        for at in range(0, len(pieces), 200):
            text = b" ".join(pieces[at:at + 200]).decode("utf-8", "replace")
            coded = self.merges.encode_batch_fast([text], add_special_tokens=False)[0]
            found.append(np.array(coded.ids, dtype=np.uint32))
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces) or (len(ends) and ends[-1] != len(ids)):
            raise ValueError("a piece is not one word of this tokenizer")
        self._add(pieces, ids, ends)

    def _learn_whole(self, words: list[bytes]) -> None:
        found = [self.whole(x.decode("utf-8", "replace")) for x in words]
        if found:
            self._add(words, np.concatenate(found), np.cumsum([len(x) for x in found]))

    def _block(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a buffer that starts and ends between words, and per run of ids where in the buffer it
        begins and how many ids it has."""
        buffer = _LOWER[buffer]
        kinds = _KINDS[buffer]
        for first, second in NOT_LATIN:
            at = np.flatnonzero((buffer[:-1] == first) & (buffer[1:] == second))
            kinds[at] = ODD
        at = np.flatnonzero((buffer[:-1] == ord("<")) & (buffer[1:] == ord("|")))
        kinds[at] = ODD
        inside = kinds != BLANK
        turns = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        words, stops = turns[::2], turns[1::2]
        odd_at = np.flatnonzero(kinds == ODD)
        odd = np.unique(np.searchsorted(words, odd_at, side="right") - 1)
        for low, high in zip(words[odd].tolist(), stops[odd].tolist(), strict=True):
            kinds[low:high] = ODD
        new = np.ones(len(buffer), dtype=bool)
        new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        new &= kinds != BLANK
        starts = np.flatnonzero(new)
        # A piece ends where the next begins, or at the blank behind its word.
        word = np.searchsorted(words, starts, side="right") - 1
        follow = np.append(starts[1:], len(buffer))
        lengths = np.minimum(follow, stops[word]) - starts if len(starts) else starts
        # All pieces in order are the bytes between the blanks. A word with an odd byte is no plain
        # piece's equal, so the bytes alone tell how a piece is encoded.
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(offsets), pa.py_buffer(buffer[inside])]).dictionary_encode()
        entry = coded.indices.to_numpy(zero_copy_only=False)
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        whole = np.zeros(len(pieces), dtype=bool)
        whole[entry[kinds[starts] == ODD]] = True
        if len(self.place) + len(pieces) > self.most and any(p not in self.place for p in pieces):
            self._clear()
        missing = [(p, w) for p, w in zip(pieces, whole.tolist(), strict=True)
                   if p not in self.place]
        self._learn([p for p, w in missing if not w])
        self._learn_whole([p for p, w in missing if w])
        number = np.fromiter(map(self.place.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        number = number[entry]
        return self.ids[ragged(self.starts[number], self.lengths[number])], starts, self.lengths[number]

    def encode(self, texts: list[bytes], block: int = 2 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8), one text behind the other, and how many each text has.

        Works on blocks of about ``block`` bytes; a longer text is cut between words. A block's
        arrays take many times its size.
        """
        counts = np.zeros(len(texts), dtype=np.int64)
        if not self.by_piece:
            found = [self.whole(x.decode("utf-8", "replace")) for x in texts]
            counts[:] = [len(x) for x in found]
            return (np.concatenate(found) if found else np.zeros(0, np.uint32)), counts
        out: list[np.ndarray] = []
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                limits = np.cumsum([len(x) + 1 for _, x in held])
                buffer = np.frombuffer(b" ".join([*(x for _, x in held), b""]), dtype=np.uint8)
                ids, starts, count = self._block(buffer)
                owner = np.searchsorted(limits, starts, side="right")
                total = np.zeros(len(held), dtype=np.int64)
                np.add.at(total, owner, count)
                np.add.at(counts, [i for i, _ in held], total)
                out.append(ids)
            held.clear()
            size = 0

        for i, text in enumerate(texts):
            at = 0
            while at < len(text):
                to = len(text)
                if to - at > block:
                    to = text.find(b" ", at + block)
                    to = len(text) if to < 0 else to
                held.append((i, text[at:to]))
                size += to - at
                at = to
                if size >= block:
                    flush()
        flush()
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), counts


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, most: int = 1_000_000) -> Encoder:
    """The worker process's encoder for a tokenizer file that keeps up to ``most`` pieces."""
    if (path, most) not in _encoders:
        _encoders[path, most] = Encoder(path, most)
    return _encoders[path, most]
