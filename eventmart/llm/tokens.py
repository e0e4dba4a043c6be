"""Token ids of whole texts, through the tokenizers library.

Words repeat, so a task encodes each distinct piece of text once and joins the pieces' ids. A text is only
cut where the result cannot change, whatever stands around it, because both kinds of vocabulary begin a new
word there: before a single space and around a single line feed between two characters that no tokenizer here
takes for white space, and between a Latin letter and the ASCII marks in MARKS (not the apostrophe). A byte-level
vocabulary takes the space into the word after it, a word-level one drops it.

The strings of special tokens in a text are ordinary text. A null text is an empty one.
"""

import os
import re
from array import array

LONGEST_KEPT = 64     # characters of a piece that is remembered
MOST_KEPT = 600_000   # pieces remembered at a time; more only cost time
# Python's white space and the separators below 0x20 are a superset of every tokenizer's white space.
WHITE = r"\s\x1c-\x1f\x85\u180e\ufeff"
LETTERS = r"A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = r".,;:!?#$%&*|()"
ENDS = frozenset(MARKS)
SPACES = re.compile(rf"(?<=[^{WHITE}])(?= [^{WHITE}])")
INNER = re.compile(rf"(?<=[{LETTERS}])(?=[{MARKS}])|(?<=[^{WHITE}])(?=\n[^{WHITE}])|(?<=[^{WHITE}]\n)(?=[^{WHITE}])")
SOLID = re.compile(rf"[^{WHITE}](.*[^{WHITE}])?", re.S)
LETTERS_ONLY = re.compile(rf" ?[{LETTERS}]+")
# A byte-level vocabulary writes printable bytes as themselves and the others as the characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: b for b in PRINTABLE} | {b: 256 + n for n, b in enumerate(x for x in range(256) if x not in set(PRINTABLE))}


class _Known(dict):
    """Ids by text, worked out where they are asked for first and remembered in bounds: what is asked for again while a
    generation fills up moves on to the next."""

    def __init__(self, find):
        self._find, self._before = find, {}

    def __missing__(self, text):
        found = self._before.get(text)
        if found is None:
            found = self._find(text)
        if len(text) <= LONGEST_KEPT:
            if len(self) >= MOST_KEPT // 2:
                self._before = dict(self)
                self.clear()
            self[text] = found
        return found


class Encoder:
    """ids(text) gives the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        whole = self._tokenizer.encode
        self._lowers = whole("A").ids == whole("a").ids
        self._takes_space = whole(" a").ids != whole("a").ids
        self._before_word = chr(BYTE_LETTERS[32]) if self._takes_space else ""
        self._pieces = _Known(self._encode)
        self._words = _Known(self._cut)
        self._spaced = _Known(self._cut_spaced)

    def _encode(self, text):
        if LETTERS_ONLY.fullmatch(text):
            return self._spaced[text[1:]] if text[0] == " " else self._word(text)
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, text):
        """Ids of letters, after a space or not: one word of the vocabulary's own splitting, so its model's part."""
        text = text if self._takes_space else text.strip(" ")
        text = text.lower() if self._lowers else text
        return array("I", [t.id for t in self._model.tokenize(text.encode().decode("latin-1").translate(BYTE_LETTERS))]).tobytes()

    def _cut(self, text):
        return b"".join(map(self._pieces.__getitem__, INNER.split(text)))

    def _cut_spaced(self, text):
        """Ids of the text after a space; None where white space next to the space forbids the cut."""
        if text.isascii() and text.isalpha():
            word = self._before_word + (text.lower() if self._lowers else text)
            return array("I", [t.id for t in self._model.tokenize(word)]).tobytes()
        if text[-1:] in ENDS and LETTERS_ONLY.fullmatch(text, 0, len(text) - 1) and text[0] != " ":
            return self._spaced[text[:-1]] + self._pieces[text[-1]]
        if LETTERS_ONLY.fullmatch(text):
            return self._word(" " + text)
        return self._cut(" " + text) if SOLID.fullmatch(text) else None

    def ids(self, text):
        lines = text.split("\n")
        if len(lines) > 1 and all(map(SOLID.fullmatch, lines)):
            return self._pieces["\n"].join(map(self._line, lines))
        return self._line(text)

    def _line(self, text):
        first, *rest = text.split(" ")
        try:
            if not rest or SOLID.fullmatch(first):
                return self._words[first] + b"".join(map(self._spaced.__getitem__, rest))
        except TypeError:
            pass
        return b"".join(map(self._words.__getitem__, SPACES.split(text)))

    def batch(self, texts, end_id):
        """Ids of each text with the end id."""
        end = int(end_id).to_bytes(4, "little")
        return [self.ids(t or "") + end for t in texts]


def encoder(path):
    """The process's encoder for a vocabulary: a worker keeps what it has learnt from task to task. This module travels by
    value and is made anew for every task, so what is kept hangs on a module that the process imports once."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def row_slices(batches, rows=1000):
    """The batches in slices of so many rows at most, so that little is held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
