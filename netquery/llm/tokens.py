"""Token ids of the public word-level BPE vocabulary: each distinct piece of a batch of texts goes to the vocabulary's model once."""

from __future__ import annotations

import codecs
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

AT_ONCE = 10_000        # pieces in one text for the model

# Cutting into words serves texts of these characters only: for them Unicode normal form, case
# and character classes are the same everywhere. Other texts go through the library whole.
_PLAIN = re.compile(r"[\t-\r\x20-\x7EÀ-ÖØ-öø-ÿŒœ]*")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿœ]+|[0-9]|[^\sa-z0-9ß-öø-ÿœ]+|\n")     # words are parted by line ends


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _laid(ids: np.ndarray, size: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some entries, one behind the other in `order`, and where each one begins and the last one ends. Entry i
    has `size[i]` of `ids`, behind those of the entries before it."""
    size, start = size[order], (np.cumsum(size) - size)[order]
    at = np.concatenate([[0], np.cumsum(size)])
    return ids[np.arange(at[-1]) + np.repeat(start - at[:-1], size)], at


class Ids:
    """Ids of texts as little-endian unsigned 16-bit numbers (the vocabulary has under 65,536 entries)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size(with_added_tokens=False) > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        # the byte-level alphabet: bytes that print stand for themselves, others for characters from 256 on; the space parts pieces
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = {b: 256 + i for i, b in enumerate(sorted(set(range(256)).difference(shown)))}
        self.alphabet = "".join(chr(b if b == 32 else other.get(b, b)) for b in range(256))
        # the vocabulary's model on pieces that spaces part, without its pattern; the last token of a piece ends with a mark
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.last = np.zeros(1 << 16, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, and how many each one has."""
        some = [np.zeros(0, "<u2")]
        for i in range(0, len(pieces), AT_ONCE):
            text = codecs.charmap_decode(" ".join(pieces[i:i + AT_ONCE]).encode(), "strict", self.alphabet)[0]
            some.append(np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2"))
        ids = np.concatenate(some)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("this vocabulary does not mark the last token of a piece")
        return ids, np.diff(ends, prepend=0)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and how many each one has."""
        coded = pa.array(_PIECE.findall("\n".join([*words, ""])), pa.string()).dictionary_encode()
        pieces, order = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        end = pieces.index("\n") if words else 0
        ids, size = self._pieces([p for p in pieces if p != "\n"])
        ids, at = _laid(ids, np.insert(size, end, 0), order)
        return ids, np.diff(at[:-1][order == end], prepend=0)

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        plain = ["<|" not in t and (t.isascii() and t.isprintable() or _PLAIN.fullmatch(t) is not None) for t in texts]
        words = pc.ascii_split_whitespace(pa.array([t.lower() if p else "" for t, p in zip(texts, plain, strict=True)], pa.string()))
        coded = words.values.dictionary_encode()
        ids, at = _laid(*self._words(coded.dictionary.to_pylist()), coded.indices.to_numpy())
        ids, at = ids.tobytes(), (2 * at[words.offsets.to_numpy()]).tolist()
        return [ids[at[i]:at[i + 1]] if p else self._whole(t) for i, (t, p) in enumerate(zip(texts, plain, strict=True))]
