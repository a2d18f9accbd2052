"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

Merging pairs in rank order is replaced by a search from left to right:

* an Aho-Corasick automaton over the vocabulary finds, in one pass over a word,
  every token that starts at every place;
* a token may follow another only if merging their joined text gives exactly
  these two back.  ``Vocabulary.compatible`` decides it from the merge ranks and
  the parts of tokens; answers are kept in a pair-compatibility table;
* the encoder takes the longest compatible token, and where none fits marks the
  place as dead and steps back one token.  A place dies once, so the work is
  linear in the length of the word.

The result equals the merge procedure's.  Tokens that the merges can never
produce are left out of the automaton.  Decoding joins the
token strings by a gather over one byte buffer and its offsets.

Letters and digits are those of the library's Unicode version, which is not this Python's: the
code points that Python does not know are put to the library's own normaliser and word pattern
once, when the model is loaded.

Rules: null text is empty; special tokens inside texts are matched first, as the
library does; rows that repeat a doc_id are encoded each; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.token_counts import model_file

WORD_MODEL = "word_bpe_49k.json"
END = "\n"                    # stands for the end of a word; no mapped byte is a line feed
WORDS_KEPT = 1 << 17          # encoded words a task remembers


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte, by the byte-level rule: printable Latin-1
    stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens by id; a merged token is younger than its parts (checked)."""

    def __init__(self, tokens: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        import ahocorasick

        def inner(t):
            return t[:-len(suffix)] + END if suffix and t.endswith(suffix) else t

        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in merges:
            out = tokens[a + b]
            if out in self.parts or out <= max(tokens[a], tokens[b]):
                raise ValueError(f"merge {a!r} {b!r}: ids must follow the order of merges")
            self.parts[out] = (tokens[a], tokens[b])
            self.merged[self.parts[out]] = out
        self.table: dict[tuple[int, int], bool] = {}
        self.length = {i: len(inner(t)) for t, i in tokens.items()}
        real: set[int] = set()
        self.automaton = ahocorasick.Automaton()
        for t, i in sorted(tokens.items(), key=lambda x: x[1]):
            if i not in self.parts or (self.parts[i][0] in real and self.parts[i][1] in real and self._apart(*self.parts[i], i)):
                real.add(i)
                self.automaton.add_word(inner(t), i)
        self.automaton.make_automaton()

    def _apart(self, left: int, right: int, below: int) -> bool:
        """True if no merge older than ``below`` joins text across the seam of left and right.

        Goes back in time: undoes the younger of the two merges next to the seam
        until both sides are single letters.
        """
        parts, merged = self.parts, self.merged
        while True:
            if merged.get((left, right), below) < below:
                return False
            if left in parts and (left > right or right not in parts):
                below, left = left, parts[left][1]
            elif right in parts:
                # of equal ranks the left one merges first: the seam's comes before right's
                below, right = right + 1, parts[right][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        got = self.table.get((left, right))
        if got is None:
            if len(self.table) >= 1 << 20:
                self.table.clear()
            got = self.table[left, right] = self._apart(left, right, 1 << 62)
        return got

    def encode(self, word: str) -> list[int]:
        """Ids of ``word``, spelt in vocabulary letters, END included where words have one."""
        n = len(word)
        found: list[list[int]] = [[] for _ in range(n)]
        for end, token in self.automaton.iter(word):
            found[end + 1 - self.length[token]].append(token)     # ascending length per start
        alive, ids, place = [True] * (n + 1), [], 0
        tries = [len(f) for f in found]
        while place < n:
            while tries[place]:
                tries[place] -= 1
                token = found[place][tries[place]]
                nxt = place + self.length[token]
                if alive[nxt] and (not ids or self.compatible(ids[-1], token)):
                    ids.append(token)
                    place = nxt
                    if place < n:
                        tries[place] = len(found[place])
                    break
            else:
                if not ids:
                    raise ValueError(f"no tokens spell {word!r}")
                alive[place] = False
                place -= self.length[ids.pop()]
        return ids


OTHER = "\ue000"             # a private-use character: neither letter, digit nor white space


class Unknown:
    """Code points that this Python does not assign, as the library sees them.

    ``lower`` maps those with a lower-case form to it; ``stand`` maps those that the library takes for
    another class than the ``regex`` package does to a letter, a digit or ``OTHER``.
    """

    def __init__(self, name: str, pattern: str, words):
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        # unassigned code points of the planes that hold letters
        new = [chr(c) for c in range(0x40000) if unicodedata.category(chr(c)) == "Cn"]
        normal = Tokenizer.from_file(model_file(name)).normalizer
        mapped = normal.normalize_str("!".join(new)).split("!") if normal else new
        if len(mapped) != len(new):
            raise ValueError("the normaliser joins characters that this Python does not know")
        self.lower = str.maketrans({a: b for a, b in zip(new, mapped) if a != b})
        new = list(dict.fromkeys(mapped))
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        letters = self._joined(split, "a", new)
        others = self._joined(split, "!", new)
        kind = [bool(words.fullmatch("a" + c)) * 2 + bool(words.fullmatch("!" + c)) for c in new]
        here = [2 if c in letters else 1 if c in others else 0 for c in new]
        self.stand = str.maketrans({c: ("0", OTHER, "a")[h] for c, k, h in zip(new, kind, here) if k != h})
        self.chars = frozenset(map(chr, self.lower.keys() | self.stand.keys()))

    @staticmethod
    def _joined(split, side: str, chars: list[str]) -> set[str]:
        """The characters that form one word with ``side``."""
        return {w[1] for w, _ in split.pre_tokenize_str(" ".join(side + c for c in chars)) if len(w) == 2 and w[0] == side}

    def within(self, text: str) -> bool:
        try:
            text.encode("latin-1")      # quick for most texts
            return False
        except UnicodeEncodeError:
            return not self.chars.isdisjoint(text)


class WordTokenizer:
    """The word-end tokenizer: NFC, one space for white space, lower case, words by class."""

    def __init__(self, name: str = WORD_MODEL):
        import regex
        spec = json.load(open(model_file(name), encoding="utf-8"))
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.vocabulary = Vocabulary(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        (self.pattern,) = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(self.pattern.replace(r"\s", r"\p{White_Space}"))
        self.unknown = Unknown(name, self.pattern, self.words)
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        strings = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.buffer = np.frombuffer(b"".join(strings), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        self.word_ids = lru_cache(maxsize=WORDS_KEPT)(self._word_ids)

    def _word_ids(self, word: str) -> tuple[int, ...]:
        return tuple(self.vocabulary.encode(word.encode().decode("latin-1").translate(self.letters) + END))

    @staticmethod
    def _lower(text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()   # letter by letter: no final sigma

    def _plain(self, text: str, out: list[int]) -> None:
        word_ids = self.word_ids
        if self.unknown.within(text):
            text = self._lower(text).translate(self.unknown.lower)
            words = (text[m.start():m.end()] for m in self.words.finditer(text.translate(self.unknown.stand)))
        else:
            words = self.words.findall(self._lower(text))
        for word in words:
            out += word_ids(word)

    def encode(self, text: str) -> np.ndarray:
        out: list[int] = []
        if self.cut is None or not any(s in text for s in self.special):
            self._plain(text, out)
        else:
            for i, part in enumerate(self.cut.split(text)):
                if i % 2:
                    out.append(self.special[part])
                elif part:
                    self._plain(part, out)
        return np.array(out, dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by one space (the file names no decoder)."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids.astype(np.int64) + 1] - start
        place = np.cumsum(size) - size
        return self.buffer[np.arange(int(size.sum())) + np.repeat(start - place, size)].tobytes()[:-1]


@lru_cache(maxsize=1)
def word_tokenizer(name: str) -> WordTokenizer:
    return WordTokenizer(name)


def _round_trip(model: str):
    def run(batches):
        tok = word_tokenizer(model)
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                ids = tok.encode(batch.column("text")[i].as_py() or "")
                out.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(tok.decode(ids)).hexdigest()))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(model: str):
    def run(batches):
        tok = word_tokenizer(model)
        for batch in batches:
            rows = [tok.encode(batch.column("text")[i].as_py() or "") for i in range(batch.num_rows)]
            text = [tok.decode(r).decode() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32())), pa.array(text, pa.string())],
                                             names=["doc_id", "ids", "decoded"])

    return run


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, model: str = WORD_MODEL) -> DataFrame:
    """doc_id, ids, decoded text of every row of ``docs`` (doc_id, text)."""
    return _read(docs).mapInArrow(_ids(model), "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model: str = WORD_MODEL) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text; the ids stay in their task."""
    return _read(docs).mapInArrow(_round_trip(model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
