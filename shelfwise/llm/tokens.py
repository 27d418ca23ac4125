"""Token ids of whole texts, with the ids of frequent words kept between texts.

The ids always come from the tokenizers library. Where a text can be cut at white space
without changing a single id, words that were encoded before are looked up; a text for which
that is not certain goes through the library in one piece.
"""

from __future__ import annotations

import os
import re
from array import array

import pyarrow as pa

#: Bytes of words kept by a Python worker, about; then the store starts anew.
KEPT_BYTES = 72 << 20
#: What a kept word takes beside its own characters and ids, and the most characters that it may have.
WORD_BYTES, WORD_CHARS = 130, 64
#: White space of Python that the tokenizers do not take for white space.
_ODD = re.compile("[\x1c-\x1f]")
#: A space or none, Latin letters (composed, all of category L and one letter in lower case, so without U+0130),
#: ASCII marks but the apostrophe behind them.
_SIMPLE = re.compile("( ?[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")


def _visible() -> dict[int, str]:
    """Byte-level tokenizers show printable bytes as themselves and the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(0x100 + i) for i, b in enumerate(hidden)}


_VISIBLE = _visible()
_CODERS: dict[tuple[str, str], "WordCoder"] = {}


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    ``cut``: "any" if white space is dropped between words, "spaces" if a space belongs to
    the word behind it, "none" to pass every text whole.
    """

    def __init__(self, path: str, cut: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        # Where the library looks for these after its normalizer, no text is cut.
        self.cut = "none" if any(t.normalized for t in added) else cut
        self.added = [t.content for t in added]
        self.known = _Known(self)
        self.tails: dict[str, bytes] = {}
        self.newline = self._encode(["\n"])[0]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _split(self, text: str) -> list[str] | None:
        # The library takes an added token out of a text before anything else.
        if any(content in text for content in self.added):
            return None
        if self.cut == "any" and not _ODD.search(text):
            return text.split()
        if self.cut == "spaces" and text and "\0" not in text:
            # White space in runs, of other kinds or at an end is not cut.
            if " ".join(text.split()) != text.replace("\n", " "):
                return None
            # The first word has no space before it; a line's first word keeps its newline.
            return ("\0" + text).replace("\n", " \n").split(" ")
        return None

    def _whole(self, word: str) -> str:
        """The stretch of text for which a word of ``_split`` stands, without a newline before it."""
        if self.cut == "any":
            return word
        return word[1:] if word[0] in "\0\n" else " " + word

    def _model(self, piece: str) -> bytes:
        """Ids of one stretch that the tokenizer does not split before its merges."""
        if piece.isascii():
            visible = "\u0120" + piece[1:] if piece[0] == " " else piece
        else:
            visible = piece.encode().decode("latin-1").translate(_VISIBLE)
        return array("I", [t.id for t in self.library.model.tokenize(visible)]).tobytes()

    def encode_word(self, word: str) -> bytes:
        """Ids of a word of ``_split`` that was not met before.

        Letters with marks behind them go straight to the library's merges, the two parts
        on their own as the tokenizer would split them; all other words take the full way.
        """
        whole = self._whole(word)
        coded = self.newline if self.cut == "spaces" and word[0] == "\n" else b""
        if simple := _SIMPLE.fullmatch(whole):
            stem, tail = simple.groups()
            coded += self._model(stem.lower() if self.cut == "any" else stem)
            if tail:
                if tail in self.tails:
                    coded += self.tails[tail]
                else:
                    found = self._model(tail)
                    if len(tail) <= 4:  # few, as there are only so many marks
                        self.tails[tail] = found
                    coded += found
        elif whole:
            coded += self._encode([whole])[0]
        return coded

    def ids(self, texts: list[str | None]) -> list[bytes]:
        texts = ["" if t is None else t for t in texts]
        get = self.known.__getitem__
        out, rest = [], []
        for i, text in enumerate(texts):
            split = self._split(text)
            out.append(b"".join(map(get, split)) if split is not None else b"")
            if split is None:
                rest.append(i)
        if rest:
            for i, coded in zip(rest, self._encode([texts[i] for i in rest]), strict=True):
                out[i] = coded
        return out


    def release(self) -> None:
        self.known.forget()


class _Known(dict):
    """Ids by word; a word that is missing is encoded, and kept while it is short and there is room."""

    def __init__(self, owner: WordCoder):
        self.owner, self.size = owner, 0

    def forget(self) -> None:
        self.clear()
        self.owner.tails.clear()
        self.size = 0

    def __missing__(self, word: str) -> bytes:
        coded = self.owner.encode_word(word)
        if len(word) <= WORD_CHARS:
            self.size += WORD_BYTES + len(word) + len(coded)
            if self.size > KEPT_BYTES:
                self.forget()
            self[word] = coded
        return coded


def release() -> None:
    """For tasks of other operators: forget all words that tokenizers kept in this worker, and give free memory back.

    Tasks of one stage share the store, since most of a task's rare words were met in an earlier one.
    """
    for one in _CODERS.values():
        one.release()
    pa.default_memory_pool().release_unused()


def coder(path: str, cut: str) -> WordCoder:
    """The worker's coder for a tokenizer file, made once."""
    if (path, cut) not in _CODERS:
        _CODERS[path, cut] = WordCoder(path, cut)
    return _CODERS[path, cut]
