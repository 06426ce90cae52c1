"""Whole-text token ids: quick on ordinary text, exact on text without spaces.

Ordinary text goes to the compiled encoder in one call. A word of very many
characters goes through ``tree_ids``: halves are encoded apart and joined
exactly.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Words longer than this are encoded in halves.
UNSPLIT = 4096
#: Fixed value: how byte-level vocabularies split text into words.
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=\S) ")
_ODD = re.compile(r"\s ")
#: Text whose lower case and composition are plain: ASCII and Latin-1 letters.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_PLAIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+"
)
_LOADED: dict[tuple, object] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 stands for itself, the rest for the letters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder for a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec["truncation"] = spec["padding"] = None
        self.path = path
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_id = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(f"({re.escape(s)})" for s in self.special) or r"(?!)")
        token_of = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.special_id.items()}
        #: Bytes of a token: one letter stands for one byte.
        self.letters = [token_of.get(i, "") for i in range(max(token_of) + 1)]
        self.quick = self._compiled(spec)

    # each of the library's encoders takes some 100 MB of a worker: made where one is needed

    def _spec(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            return dict(json.load(f), truncation=None, padding=None)

    @cached_property
    def whole(self) -> Tokenizer:
        """The vocabulary as it stands."""
        return Tokenizer.from_str(json.dumps(self._spec()))

    @cached_property
    def bare(self) -> Tokenizer:
        """Merges alone, for a word in byte letters."""
        spec = dict(self._spec(), pre_tokenizer=None, normalizer=None, added_tokens=[], post_processor=None)
        return Tokenizer.from_str(json.dumps(spec))

    def _compiled(self, spec: dict):
        """The same vocabulary in a faster encoder, if ids follow the order of merges."""
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merged = [vocab.get(a + b, -1) for a, b in pairs]
        if merged != sorted(merged) or spec["pre_tokenizer"].get("add_prefix_space"):
            return None
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in vocab.items()
            if token not in self.special_id
        }
        return tiktoken.Encoding(
            "vocabulary", pat_str=BYTE_WORDS, mergeable_ranks=ranks,
            special_tokens=self.special_id,
        )

    # -- whole texts ------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        """Parts of the text; a space stood before each but the first."""
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def ids_of(self, texts: list[str], unsplit: int = UNSPLIT) -> list[np.ndarray]:
        """Ids of each text, as the tokenizers library gives them."""
        out = []
        for text in texts:
            if len(text) > unsplit and (
                max(map(len, text.split(" "))) > unsplit or " " * unsplit in text
            ):
                out.append(self.tree_ids(text, unsplit))
            elif self.quick:
                out.append(self.quick.encode_to_numpy(text, allowed_special="all"))
            else:
                out.append(np.array(self.part_ids(-1, text), np.uint32))
        return out

    def text_of(self, ids) -> str:
        return self.whole.decode(ids, skip_special_tokens=False)

    # -- trees ------------------------------------------------------------

    def cuts(self, text: str, size: int) -> list[tuple[int, str]]:
        """Parts of at most about ``size`` characters: (run, string).

        Run -1: ordinary text that starts and ends where no token can reach
        over. Others: parts of one word too long to keep whole, written in byte
        letters; parts with one number belong together.
        """
        out: list[tuple[int, str]] = []
        held: list[str] = []
        runs = held_size = 0

        def flush() -> None:
            nonlocal held_size
            if held:
                out.append((-1, "".join(held)))
            held.clear()
            held_size = 0

        def hold(piece: str) -> None:
            nonlocal held_size
            if held_size + len(piece) > size:
                flush()
            held.append(piece)
            held_size += len(piece)

        for i, piece in enumerate(self.pieces(text)):
            piece = " " * bool(i) + piece
            if len(piece) <= size:
                hold(piece)
                continue
            for plain in self.special_at.split(piece):
                if not plain:
                    continue
                if plain in self.special_id:
                    hold(plain)
                    continue
                found = self.whole.pre_tokenizer.pre_tokenize_str(plain)
                for letters, (start, end) in found:
                    if len(letters) <= size:
                        hold(plain[start:end])
                        continue
                    flush()
                    out += [(runs, half) for half in self._halves(letters, size)]
                    runs += 1
        flush()
        return out

    def _halves(self, letters: str, size: int) -> list[str]:
        if len(letters) <= size:
            return [letters]
        middle = len(letters) // 2
        return self._halves(letters[:middle], size) + self._halves(letters[middle:], size)

    def part_ids(self, run: int, part: str) -> list[int]:
        if run < 0:
            if self.quick:
                return self.quick.encode(part, allowed_special="all")
            return self.whole.encode(part, add_special_tokens=False).ids
        return self.bare.encode(part, add_special_tokens=False).ids

    def tree_ids(self, text: str, size: int = UNSPLIT) -> np.ndarray:
        parts = self.cuts(text, size)
        return self.join([(run, self.part_ids(run, part)) for run, part in parts])

    def join(self, parts: list[tuple[int, list[int]]]) -> np.ndarray:
        """Ids of the whole from the ids of its parts, in order."""
        out: list[int] = []
        at = 0
        while at < len(parts):
            run, end = parts[at][0], at + 1
            while run >= 0 and end < len(parts) and parts[end][0] == run:
                end += 1
            level = [list(ids) for _, ids in parts[at:end]]
            while len(level) > 1:
                level = [
                    self.join_two(level[i], level[i + 1]) if i + 1 < len(level) else level[i]
                    for i in range(0, len(level), 2)
                ]
            out += level[0]
            at = end
        return np.array(out, np.uint32)

    def join_two(self, left: list[int], right: list[int], window: int = 4) -> list[int]:
        """Encode ever more tokens about the join anew until both sides agree.

        A list of tokens is the encoding of its bytes if every two neighbours
        are the encoding of theirs. Sharing one token with each side at the same
        place makes all neighbours of the spliced list such pairs.
        """
        while True:
            a, b = left[-window:], right[:window]
            here = self.bare.encode(
                "".join(self.letters[i] for i in a + b), add_special_tokens=False
            ).ids
            places: dict[tuple[int, int], int] = {}
            at = 0
            for k, token in enumerate(here):
                places[at, token] = k
                at += len(self.letters[token])
            whole_left, whole_right = len(a) == len(left), len(b) == len(right)
            start = 0 if whole_left else None
            keep_left = 0 if whole_left else None
            at = 0
            for k, token in enumerate(a):
                if start is None and (at, token) in places:
                    start, keep_left = places[at, token], len(left) - len(a) + k
                at += len(self.letters[token])
            stop = len(here) if whole_right else None
            keep_right = len(right) if whole_right else None
            for k, token in enumerate(b):
                if (at, token) in places and not whole_right:
                    stop, keep_right = places[at, token], k
                at += len(self.letters[token])
            if start is not None and stop is not None:
                return left[:keep_left] + here[start:stop] + right[keep_right:]
            window *= 2


class WordBpe:
    """Encoder for a vocabulary of lower-case words with a mark at their end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec["truncation"] = spec["padding"] = None
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.special = [t["content"] for t in spec["added_tokens"]]
        size = self.whole.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 65536 else np.dtype("<u4")
        self.quick = self._compiled(spec, size)

    def _compiled(self, spec: dict, size: int):
        """The same vocabulary in a faster encoder; byte 0 is the mark of a word's end."""
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        vocab, mark = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merged = [vocab.get(a + b, -1) for a, b in pairs]
        if merged != sorted(merged) or max(vocab[c + mark] for c in byte_of) > merged[0]:
            return None
        ranks = {
            bytes(byte_of[c] for c in token.removesuffix(mark)) + b"\0" * token.endswith(mark): i
            for token, i in vocab.items()
            if token not in self.special
        }
        ranks[b"\0"] = size
        return tiktoken.Encoding(
            "words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={}
        )

    def _ids(self, text: str) -> np.ndarray:
        if self.quick and _PLAIN.fullmatch(text) and "<|" not in text:
            words = _PLAIN_WORDS.findall(text.lower())
            if not words:
                return np.zeros(0, self.dtype)
            words.append("")
            return self.quick.encode_to_numpy("\0".join(words)).astype(self.dtype)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.dtype)

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the tokenizers library gives them.

        Text of ASCII and Latin-1 letters is split here, where lower case and
        composition are plain; any other text goes to the library whole.
        """
        return [self._ids(t) for t in texts]


def loaded(kind: type, path: str):
    """One encoder a worker process."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


def batches(texts: list[str], chars: int = 1_000_000):
    """Ranges of texts of about so many characters together."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)
