"""Token ids of whole texts from public vocabularies, by a memo of the texts' words.

The tokenizers used here never join anything across a place where white space follows
another character, so a text's ids are those of its words (with the white space before them), one after
another. A task encodes every word it meets once and keeps the ids; a corpus repeats its words, so
most of a text costs a look-up a word. Texts are taken some at a time, and a full memo forgets the
words it has met only once (all words, if that is not enough), so memory does not grow with the corpus.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import repeat
from string import ascii_letters

import numpy as np

#: Texts taken at a time: so many characters (or one longer text).
GROUP_CHARS = 2_000_000
#: The memo is full beyond so many words or ids.
MEMO_WORDS, MEMO_IDS = 900_000, 8_000_000


def groups(texts: Sequence[str], chars: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """[start, end) of consecutive texts that hold about ``chars`` characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def spaced_words(text: str) -> list[str]:
    """``text`` cut at single spaces between other characters.

    ``" ".join`` of the result is the text. A piece that ends in white space, or is empty, stays with
    the next one, so every cut stands between a character that is no white space and a space.
    """
    words = text.split(" ")
    if "" not in words and not any(w[-1].isspace() for w in words):
        return words
    out, open_ = [], ""
    for w in words:
        open_ += w
        if open_ and not open_[-1].isspace():
            out.append(open_)
            open_ = ""
        else:
            open_ += " "
    if open_:
        out.append(open_[:-1])
    return out


def bare_words(text: str) -> list[str]:
    """The words between spaces and line ends, for tokenizers that drop white space."""
    return text.replace("\n", " ").split(" ")


class Memo:
    """Ids of words under one or more encoders, as indices into growing arrays.

    An encoder takes a list of words and returns a list of ids for each.
    """

    def __init__(self, cut: Callable[[str], list[str]], *encoders: Callable[[list[str]], list[Sequence[int]]]):
        self.cut, self.encoders = cut, encoders
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.met = np.zeros(0, dtype=np.int64)
        self.ids = [array("i") for _ in self.encoders]
        self.at = [array("q", [0]) for _ in self.encoders]

    def _full(self, share: float = 1.0) -> bool:
        return len(self.index) > share * MEMO_WORDS or sum(map(len, self.ids)) > share * MEMO_IDS

    def _forget(self) -> None:
        """Keep the words met more than once."""
        words, met, ids, at = list(self.index), self.met, self.ids, self.at
        self._clear()
        kept = np.flatnonzero(met > 1).tolist()
        for old, old_at, new, new_at in zip(ids, at, self.ids, self.at, strict=True):
            for i in kept:
                new.extend(old[old_at[i]:old_at[i + 1]])
                new_at.append(len(new))
        self.index = {words[i]: k for k, i in enumerate(kept)}
        self.met = np.ones(len(kept), dtype=np.int64)
        if self._full(0.75):
            self._clear()

    def _learn(self, words: list[str]) -> None:
        for encode, ids, at in zip(self.encoders, self.ids, self.at, strict=True):
            for x in encode(words):
                ids.extend(x)
                at.append(len(ids))
        n = len(self.index)
        self.index.update((w, n + i) for i, w in enumerate(words))

    def encode(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each encoder (ids, offsets): text i has ids[offsets[i]:offsets[i + 1]]."""
        if self._full():
            self._forget()
        words, ends = [], [0]
        for t in texts:
            words += self.cut(t)
            ends.append(len(words))
        codes = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(codes < 0)
        if len(new):
            unknown = [words[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(unknown)))
            codes[new] = np.fromiter(map(self.index.__getitem__, unknown), dtype=np.int64, count=len(unknown))
        met = np.bincount(codes, minlength=len(self.index))
        met[:len(self.met)] += self.met
        self.met, out = met, []
        for ids, at in zip(self.ids, self.at, strict=True):
            a = np.frombuffer(at, dtype=np.int64) if len(at) else np.zeros(1, np.int64)
            n = a[codes + 1] - a[codes]
            end = np.cumsum(n)
            total = int(end[-1]) if len(end) else 0
            take = np.repeat(a[codes] - (end - n), n) + np.arange(total)
            pool = np.frombuffer(ids, dtype=np.intc) if len(ids) else np.zeros(0, np.intc)
            out.append((pool[take], np.concatenate([[0], end])[ends]))
            del a, pool  # else the arrays could not grow
        return out


def json_tokenizer(path: str, plain_specials: bool):
    """A tokenizer file's tokenizer; special strings in texts are plain text if asked."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain_specials
    return tokenizer


def json_encoder(path: str, plain_specials: bool, prefix: str = "") -> Callable[[list[str]], list[Sequence[int]]]:
    """Words, each after ``prefix``, by a tokenizer file (see :func:`json_tokenizer`)."""
    tokenizer = json_tokenizer(path, plain_specials)
    return lambda words: [e.ids for e in tokenizer.encode_batch_fast([prefix + w for w in words],
                                                                     add_special_tokens=False)]


# Letters that stay letters, one for one, when composed and lower-cased; signs; and all else but white space.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_UNIT = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[0-9]|[!-/:-@\[-`{{-~]+")
_OTHER = re.compile(rf"[^{_LETTER}\t-\r -~]|<\|")
#: The bytes of Latin-1 that are not other.
_KNOWN = bytes(i for i in range(256) if not _OTHER.match(chr(i)))
#: Those of them that are letters or white space.
_WORDY = bytes(i for i in _KNOWN if chr(i).isalpha() or chr(i).isspace())
#: Different signs and digits of a text that are set apart one by one.
FEW_SIGNS, FEW_DIGITS = 4, 10


def units(text: str) -> list[str]:
    """The units of a text for a vocabulary that drops white space and case and merges within
    units only: runs of letters, digits, runs of signs, and the English endings behind an apostrophe.

    Texts with characters that composing or lower-casing could move to another unit, or with what
    may be a special string, are cut at white space only.
    """
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return bare_words(text) if _OTHER.search(text) else _UNIT.findall(text.lower())
    if raw.translate(None, _KNOWN) or b"<|" in raw:
        return bare_words(text)
    text = text.lower()
    digits, signs = [], []
    for c in set(raw.translate(None, _WORDY).decode("latin-1")):
        (digits if c.isdigit() else signs).append(c)
    # few signs, none beside another and no apostrophe: all units stand between white space once these are set apart
    if len(signs) > FEW_SIGNS or len(digits) > FEW_DIGITS or "'" in signs or any(a + b in text for a in signs for b in signs):
        return _UNIT.findall(text)
    for c in signs + digits:
        text = text.replace(c, f" {c} ")
    return text.split()


class WordEndEncoder:
    """Units (see :func:`units`) or words by a vocabulary that marks the end of every unit.

    White space separates units and is dropped, so many units go through the tokenizer as one spaced
    text, and the marks tell whose ids are whose.
    """

    MARK = "</w>"

    def __init__(self, path: str):
        import json

        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(self.MARK)]] = True
        tokenizer = json_tokenizer(path, plain_specials=False)
        self.whole = lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        # small letters of ASCII reach the model as they are, unless an added token is found among them
        added = any(set(t.content) <= set(ascii_letters + " ") for t in tokenizer.get_added_tokens_decoder().values())
        self.model = None if added else tokenizer.model

    def _units(self, part: list[str]) -> list[Sequence[int]]:
        ids = self.whole([" ".join(part)])[0]
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) != len(part) or cut[-1] != len(ids):
            return self.whole(part)
        cut = cut.tolist()
        return [ids[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)]

    def __call__(self, words: list[str]) -> list[Sequence[int]]:
        made: dict[str, Sequence[int]] = {}
        if self.model:
            tokens = self.model.tokenize
            made = {w: [t.id for t in tokens(w)] for w in words if w.isascii() and w.isalpha() and w.islower()}
        # letters only, or one unit: whatever else they turn out to be, the marks are counted below
        plain = [w for w in words if w not in made and (w.isalpha() or _UNIT.fullmatch(w) and not _OTHER.search(w))]
        for i in range(0, len(plain), 2000):
            made.update(zip(plain[i:i + 2000], self._units(plain[i:i + 2000]), strict=True))
        rest = [w for w in words if w not in made]
        made.update(zip(rest, self.whole(rest), strict=True))
        return [made[w] for w in words]


def piece_encoder(path: str) -> Callable[[list[str]], list[Sequence[int]]]:
    """Words by a piece model, which itself puts a space before each.

    Texts with U+2581 itself, the model's sign for a space, are not those of their words.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    space = [model.piece_to_id("\u2581")]  # the model gives no token for an empty text
    return lambda words: [x or space for x in model.encode(words, num_threads=1)]
