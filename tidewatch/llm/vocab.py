"""Public vocabularies on the executors, and the ids of texts by them.

A vocabulary file is read once on the driver and travels as a broadcast of its bytes (under 2 MB).
A worker process keeps its tokenizer, and the ids of the pieces of text that it has met.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import xxhash

from tidewatch.llm.common import runs

#: Fixed value: the split of the public rank files (same text as public_tokenizers.PATTERN).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space besides space and newline.
ODD = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the rest from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def from_json(data: bytes):
    """A tokenizers file; strings of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(data.decode())
    tokenizer.encode_special_tokens = True
    return tokenizer


def from_ranks(data: bytes):
    """A byte-level BPE of the tokenizers library that merges by the ranks of a rank file.

    Every way to put a token together from two tokens is a merge, at the token's rank; of equal rank
    the longer left part comes first, as merging from the left makes it. A piece that is a token is kept whole.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    ranks, alphabet = read_ranks(data), byte_alphabet()
    word = {token: "".join(alphabet[b] for b in token) for token in ranks}
    merges = [
        (word[token[:cut]], word[token[cut:]])
        for token in sorted(ranks, key=ranks.get) for cut in range(len(token) - 1, 0, -1)
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    tokenizer = Tokenizer(models.BPE(vocab={word[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(PATTERN), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tokenizer


def from_pieces(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def sections(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Parts of a long text, cut only before a space that follows a character other than white space."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


class Memo:
    """Ids of pieces, each encoded once while it is remembered.

    ``encode`` maps a list of pieces to their ids. At most ``limit`` pieces of at most ``longest`` characters are
    remembered; beyond that, the half met least is forgotten. Results don't depend on it.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 400_000, longest: int = 64):
        self.encode, self.limit, self.longest = encode, limit, longest
        self._empty()

    def _empty(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.sizes, self.met = (np.zeros(1 << 18, np.int64) for _ in range(3))
        self.pieces = 0

    def _add(self, ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self._add_flat(np.fromiter((i for one in ids for i in one), np.uint32, int(sizes.sum())), sizes)

    def _add_flat(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.pieces + len(sizes) > len(self.starts):
            self.starts, self.sizes, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.met))
        self.flat[self.used:self.used + len(flat)] = flat
        at = slice(self.pieces, self.pieces + len(sizes))
        self.sizes[at], self.starts[at], self.met[at] = sizes, self.used + np.cumsum(sizes) - sizes, 0
        self.pieces, self.used = self.pieces + len(sizes), self.used + len(flat)

    def _forget(self) -> None:
        names, codes = list(self.codes), np.fromiter(self.codes.values(), np.int64, len(self.codes))
        best = np.sort(np.argsort(-self.met[codes], kind="stable")[:self.limit // 2])
        flat, sizes = self.ids(codes[best]), self.sizes[codes[best]]
        self._empty()
        self._add_flat(flat, sizes)
        self.codes = {names[i]: code for code, i in enumerate(best)}

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """A code for each piece, good until the next call."""
        if len(self.codes) > self.limit:
            self._forget()
        elif self.pieces > len(self.codes):  # what was too long to remember
            self.pieces = len(self.codes)
            self.used = int(self.starts[self.pieces - 1] + self.sizes[self.pieces - 1]) if self.pieces else 0
        codes = np.fromiter(map(self.codes.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = list(dict.fromkeys(pieces[i] for i in missing))
            new.sort(key=lambda p: len(p) > self.longest)  # stable: those to remember come first
            first = self.pieces
            for at in range(0, len(new), 20_000):
                self._add(self.encode(new[at:at + 20_000]))
            found = dict(zip(new, range(first, first + len(new))))
            codes[missing] = [found[pieces[i]] for i in missing]
            self.codes.update((p, c) for p, c in found.items() if len(p) <= self.longest)
        self.met[:self.pieces] += np.bincount(codes, minlength=self.pieces)
        return codes

    def ids_of(self, piece: str) -> list[int] | None:
        """Ids of a piece that is remembered."""
        code = self.codes.get(piece)
        return None if code is None else self.flat[self.starts[code]:self.starts[code] + self.sizes[code]].tolist()

    def counts(self, codes: np.ndarray) -> np.ndarray:
        return self.sizes[codes]

    def ids(self, codes: np.ndarray) -> np.ndarray:
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[codes] - (ends - sizes), sizes) + np.arange(total)]


class ByteBpe:
    """Ids of texts by a byte-level BPE tokenizer whose pattern never crosses from text to white space.

    So a text falls into chunks, each some white space and what follows it up to the next, which give the same ids
    alone. A chunk is named by its text without the leading space; names that begin with a carriage return hold
    a chunk as it stands. Most texts are cut by ``split``; one with other or repeated white space by a pattern, or is one chunk.
    """

    LAST_LETTER = "\u024f"  # letters up to here are letters in every version of Unicode

    def __init__(self, tokenizer, limit: int = 400_000):
        self.model, self.pattern = tokenizer.model, tokenizer.pre_tokenizer
        self.alphabet = {byte: ord(c) for byte, c in enumerate(byte_alphabet()) if byte != ord(c)}
        self.memo = Memo(self._encode, limit)

    def _mapped(self, piece: str) -> str:
        """The piece's bytes as characters of the byte alphabet."""
        return piece.encode().decode("latin-1").translate(self.alphabet)

    def _pieces(self, name: str) -> list[str]:
        lead, body = (name[1:2], name[2:]) if name[:1] == "\r" else ("\n", name[1:]) if name[:1] == "\n" else (" ", name)
        word, end = (body[:-1], body[-1]) if body[-1:] in (".", ",") else (body, "")
        if lead in (" ", "\n") and word.isalpha() and max(word) <= self.LAST_LETTER:
            pieces = [self._mapped(lead + word)] if lead == " " else [self._mapped(lead), self._mapped(word)]
            return [*pieces, end] if end else pieces
        return [piece for piece, _ in self.pattern.pre_tokenize_str(lead + body)]

    def _encode(self, names: list[str]) -> list[list[int]]:
        pieces = [self._pieces(name) for name in names]
        tokenize = self.model.tokenize
        ids: dict[str, list[int]] = {}
        for name, one in zip(names, pieces):
            known = self.memo.ids_of(name[:-1]) if len(one) == 2 and one[1] == name[-1] else None  # a word that has been met without its stop
            if known is not None:
                ids[one[0]] = known
            for piece in one:
                if piece not in ids:
                    ids[piece] = [t.id for t in tokenize(piece)]
        return [ids[one[0]] if len(one) == 1 else [i for p in one for i in ids[p]] for one in pieces]

    def _chunks(self, text: str) -> list[str]:
        if any(space in text for space in ODD):
            return ["\r" + text]
        if "  " in text or "\n\n" in text or "\n " in text or text[:1] in ("", " ", "\n") or text[-1] in " \n":
            return ["\r" + chunk for chunk in CHUNK.findall(text)]
        names = text.replace("\n", " \n").split(" ")
        names[0] = "\r" + names[0]
        return names

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        flat, sizes, owner, parts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], [], []
        for i, text in enumerate(texts):
            for part in sections(text):
                owner.append(i)
                parts.append(part)
        for run in runs(parts):
            names: list[str] = []
            ends = []
            for part in run:
                names += self._chunks(part)
                ends.append(len(names))
            codes = self.memo.look_up(names)
            before = np.concatenate([[0], np.cumsum(self.memo.counts(codes))])
            sizes.append(np.diff(before[np.array([0, *ends])]))
            flat.append(self.memo.ids(codes))
        counts = np.bincount(np.array(owner, np.int64), weights=np.concatenate(sizes), minlength=len(texts)).astype(np.int64)
        return np.concatenate(flat), counts


class FlatMemo(Memo):
    """A memo whose ``encode`` gives the ids of all pieces one after another, and how many each has."""

    def _add(self, ids: tuple[np.ndarray, np.ndarray]) -> None:
        self._add_flat(*ids)

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """As above, with the steps for new pieces done list by list."""
        if len(self.codes) > self.limit:
            self._forget()
        elif self.pieces > len(self.codes):
            self.pieces = len(self.codes)
            self.used = int(self.starts[self.pieces - 1] + self.sizes[self.pieces - 1]) if self.pieces else 0
        codes = np.fromiter(map(self.codes.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            words = list(map(pieces.__getitem__, missing.tolist()))
            new = list(dict.fromkeys(words))
            long = max(map(len, new)) > self.longest
            if long:
                new.sort(key=lambda p: len(p) > self.longest)  # stable: those to remember come first
            first = self.pieces
            for at in range(0, len(new), 20_000):
                self._add(self.encode(new[at:at + 20_000]))
            found = dict(zip(new, range(first, first + len(new))))
            codes[missing] = np.fromiter(map(found.__getitem__, words), np.int64, len(words))
            self.codes.update(((p, c) for p, c in found.items() if len(p) <= self.longest) if long else found)
        self.met[:self.pieces] += np.bincount(codes, minlength=self.pieces)
        return codes


class WordBpe(ByteBpe):
    """The same ids; new words of letters are encoded by one call of the library for all of a step, without an object per word.

    Such a word, with its space in front, is one piece, and only its first token begins with the space: so the ids of all words
    come in one list that falls apart at those tokens. A full stop or comma after a word is a piece and a token of its own.
    """

    def __init__(self, tokenizer, words, limit: int = 400_000):
        """``words``: the same model in a tokenizer that splits nothing."""
        super().__init__(tokenizer, limit)
        self.memo, self.tokenizer, self.words = FlatMemo(self._encode_flat, limit), tokenizer, words
        self.stops = {c: tokenizer.token_to_id(c) for c in ".,"}
        self.space = byte_alphabet()[32]
        self.first = np.array([(tokenizer.id_to_token(i) or "").startswith(self.space) for i in range(tokenizer.get_vocab_size())])

    def _chunks(self, text: str) -> list[str]:
        if text[:1] == " " and text[1:2] not in ("", " ", "\n"):  # the space is that of the first chunk, as of any other
            names = super()._chunks(text[1:])
            if len(names) == 1 or names[1][:1] != "\r":
                return [names[0][1:], *names[1:]] if not any(space in text for space in ODD) else ["\r" + text]
        return super()._chunks(text)

    @staticmethod
    def _chunk(name: str) -> str:
        return name[1:] if name[:1] == "\r" else name if name[:1] == "\n" else " " + name

    def _encode_flat(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        slots, ends = [0] * len(names), np.full(len(names), -1, np.int64)
        fresh: dict[str, int] = {}
        place, codes_of = fresh.setdefault, self.memo.codes.get
        known, odd, last = [], [], self.LAST_LETTER
        for i, name in enumerate(names):
            if name.isalpha() and (name.isascii() or max(name) <= last):
                slots[i] = place(name, len(fresh))
                continue
            stop, base = self.stops.get(name[-1:]), name[:-1]
            if stop is None or not base.isalpha() or not (base.isascii() or max(base) <= last):
                odd.append(i)
                continue
            ends[i] = stop
            code = codes_of(base)
            if code is not None:  # the word has been met without its stop
                known.append((i, code))
            else:
                slots[i] = place(base, len(fresh))
        slots = np.array(slots, np.int64)
        flat = np.zeros(0, np.uint32)
        if fresh:
            pieces = [self.space + word if word.isascii() else self._mapped(" " + word) for word in fresh]
            flat = np.array(self.words.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        starts = np.flatnonzero(self.first[flat])
        if len(starts) != len(fresh):
            raise ValueError("a word whose tokens do not show where it begins")
        of_known, codes = np.array(known, np.int64).reshape(-1, 2).T
        others = [one.ids for one in self.tokenizer.encode_batch_fast([self._chunk(names[i]) for i in odd], add_special_tokens=False)]
        sizes = np.concatenate([np.diff(np.append(starts, len(flat))), self.memo.sizes[codes], np.fromiter(map(len, others), np.int64, len(others))])
        flat = np.concatenate([flat, self.memo.ids(codes), np.fromiter((i for one in others for i in one), np.uint32)])
        slots[of_known] = len(fresh) + np.arange(len(known))
        slots[odd] = len(fresh) + len(known) + np.arange(len(odd))
        begins, own = (np.cumsum(sizes) - sizes)[slots], sizes[slots]
        counts = own + (ends >= 0)
        out = np.zeros(int(counts.sum()), np.uint32)
        at = np.cumsum(counts) - counts
        inner = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        out[np.repeat(at, own) + inner] = flat[np.repeat(begins, own) + inner]
        stopped = ends >= 0
        out[(at + own)[stopped]] = ends[stopped]
        return out, counts


_LOADED: dict[tuple[str, int], object] = {}


def loaded(kind: Callable, data: bytes):
    """``kind(data)``, made once in a worker process. A kind that remembers pieces takes the place of others that do."""
    key = (kind.__name__, xxhash.xxh64_intdigest(data))
    if key not in _LOADED:
        made = kind(data)
        if hasattr(made, "memo"):
            unload()
        _LOADED[key] = made
    return _LOADED[key]


def unload() -> None:
    """Forgets what the worker's earlier tasks remembered, so that the memory serves others."""
    for key in [k for k, made in _LOADED.items() if hasattr(made, "memo")]:
        del _LOADED[key]


def json_bpe(data: bytes) -> ByteBpe:
    return ByteBpe(from_json(data), limit=800_000)


def word_bpe(data: bytes, limit: int = 1_200_000) -> WordBpe:
    """``json_bpe`` with words by the list; the library's own cache of words is off, as the memo takes its place."""
    from tokenizers import Tokenizer, models

    tokenizer, model = from_json(data), json.loads(data)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    options = {k: model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k) is not None}
    flags = {k: bool(model.get(k)) for k in ("fuse_unk", "byte_fallback", "ignore_merges")}
    words = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **options, **flags))
    return WordBpe(tokenizer, words, limit)


def ranks_bpe(data: bytes) -> ByteBpe:
    return ByteBpe(from_ranks(data))
