"""Reading the public vocabulary files, and the safe places to cut a text."""

from __future__ import annotations

import base64
import functools
import json
import os
import re
from array import array
from collections.abc import Iterator

#: The end id that follows each document.
END_ID = 0
#: Characters of a piece that a library gets at once.
PIECE = 50_000
#: A piece ends before a single space between two characters that aren't white space: no match of the pattern spans that place.
SAFE = re.compile(r"(?<=\S) (?=\S)")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def tiktoken_encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def json_tokenizer(path: str, special_as_text: bool = False):
    """The tokenizer of a file. special_as_text: a special token's string inside a text is ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    if special_as_text:
        found.encode_special_tokens = True
    return found


@functools.cache
def form_of(path: str) -> tuple[bool, tuple[str, ...]]:
    """Whether texts can be cut for a tokenizer (byte-level BPE without a normalizer), and the strings of its special tokens."""
    tokenizer = json_tokenizer(path)
    if tokenizer.get_vocab_size() > 65536:
        raise ValueError("the vocabulary has more than 65,536 ids")
    file = json.loads(tokenizer.to_str())
    before = file["pre_tokenizer"] or {}
    cuts = file["model"]["type"] == "BPE" and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and not file["normalizer"]
    return cuts, tuple(x["content"] for x in file["added_tokens"])


def safe_pieces(text: str, size: int) -> Iterator[str]:
    """text in pieces of about `size` characters, cut at safe places only; encoding them one by one gives the ids of the whole."""
    start = 0
    while len(text) - start > size and (m := SAFE.search(text, start + size)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


#: Chunks whose ids a task keeps, twice: those met since so many others were, and those met before that.
CACHE = 250_000
#: A mark after letters that ends a word: the pattern begins a new match there.
MARKS = frozenset(".,;:!?")
#: Printable stand-ins of the byte-level alphabet: bytes that are printable stand for themselves, the others follow from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STAND_INS = str.maketrans({chr(b): chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)})


class Encoder:
    """The ids of texts by the tokenizers library, as little-endian unsigned 16-bit bytes (vocabularies of up to 65,536 ids).

    The library's byte-level pre-tokenizer matches nothing across a single line end between two characters that aren't
    white space, nor across the place before such a single space. A text is cut there, and each different chunk is
    encoded once while it is kept: a word of letters, with a mark after it or not, by the library's model alone (no
    match of the pattern is in doubt), any other chunk by the whole tokenizer. Texts with more white space at
    such a place or at an end, or with a special token's string, and files with another pre-tokenizer or a normalizer go to
    the library whole.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        self.tokenizer, (self.cuts, special) = json_tokenizer(path, special_as_text), form_of(path)
        self.special = () if special_as_text else special
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.marks = {m: self.of_match(m) for m in MARKS} if self.cuts else {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_match(self, text: str) -> bytes:
        """The ids of one match of the pattern."""
        return array("H", [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(_STAND_INS))]).tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if not self.cuts or not texts:
            return self.whole(texts)
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        # Chunks, with each line end as one of them; white space beside a cut leaves an empty chunk or one that has some at its end.
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n "), " ")
        at, chunks = parts.offsets.to_numpy(), parts.flatten().dictionary_encode()
        index, different = chunks.indices.to_numpy(), chunks.dictionary.to_pylist()
        # The first chunk of a line has no space before it: it is kept with one, as all others go without.
        first = np.append(True, index[:-1] == pc.index(chunks.dictionary, "\n").as_py())
        first[at[:-1]] = True
        code = 2 * index + first
        used = np.zeros(2 * len(different), bool)
        used[code] = True
        keys = [f" {different[c >> 1]}" if c & 1 else different[c >> 1] for c in np.flatnonzero(used).tolist()]
        if len(self.known) > CACHE:
            self.before, self.known = self.known, {}
        if not self.known:
            self.known["\n"] = self.known[" \n"] = self.of_match("\n")
        of = self.known.get
        found = list(map(of, keys))
        if None in found:
            self.learn([k for k, x in zip(keys, found, strict=True) if x is None])
            found = list(map(of, keys))
        missing = [i for i, x in enumerate(found) if x is None] if None in found else []
        for i in missing:
            found[i] = b""
        place = (np.cumsum(used, dtype=np.int32) - 1)[code]
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 2
        last = np.cumsum(sizes, dtype=np.int32)
        length = sizes[place]
        ends = np.cumsum(length, dtype=np.int32)
        ids = np.frombuffer(b"".join(found), "<u2")[np.repeat(last[place] - ends, length) + np.arange(ends[-1], dtype=np.int32)].tobytes()
        edges = (2 * np.append(0, ends)[at]).tolist()
        alone = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        if missing:
            odd = np.isin(place, missing)
            alone |= {i for i, x in enumerate(np.logical_or.reduceat(odd, at[:-1]).tolist()) if x}
        whole = dict(zip(sorted(alone), self.whole([texts[i] for i in sorted(alone)]), strict=True))
        return [whole[i] if i in whole else ids[a:b] for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]

    def learn(self, chunks: list[str]) -> None:
        """Keep the ids of chunks."""
        known, before, rest, tokenize, gap = self.known, self.before, [], self.model.tokenize, " ".translate(_STAND_INS)
        for c in chunks:
            if before and (found := before.get(c)) is not None:
                known[c] = found
                continue
            mark = c[-1:]
            own = c[:-1] if mark in MARKS else c
            if own.isalpha():
                word = gap + own
            elif own[:1] == " " and own[1:].isalpha():
                word = own[1:]
            else:
                word = ""
            if not word or not own.isascii() and max(own) > "\u024f":
                body = c[1:] if c[:1] == " " else c
                if body and not body[0].isspace() and not body[-1].isspace():  # else a text with it is encoded whole
                    rest.append(c)
                continue
            found = None if own is c else known.get(own) or before.get(own)
            if found is None:
                ids = tokenize(word) if own.isascii() else tokenize((own[1:] if own[0] == " " else f" {own}").encode().decode("latin-1").translate(_STAND_INS))
                known[own] = found = array("H", [t.id for t in ids]).tobytes()
            if own is not c:
                known[c] = found + self.marks[mark]
        known.update(zip(rest, self.whole([c[1:] if c[0] == " " else f" {c}" for c in rest]), strict=True))


def batches(texts: list[str], characters: int = 10_000_000) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts that together have about so many characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= characters:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
