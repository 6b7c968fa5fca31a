"""Token ids of whole texts by a public tokenizer, through per-worker caches of text chunks.

A text is cut only where the tokenizer itself always cuts, so the ids of the
chunks, one after the other, are the ids of the text.  Chunks repeat (words),
so each worker process keeps a bounded dictionary chunk -> ids and calls the
tokenizers library for misses only.  Special strings inside a text are cut out
first, as the library does.

The cuts by kind of tokenizer file:

* byte-level BPE with the usual pattern (``ByteLevel``, ``use_regex``): the
  pattern never joins a letter run with the ASCII punctuation after it, nor
  crosses white space except for one leading space; so a chunk is a letter run,
  a punctuation run, another run without white space (each with its leading
  space), or white space as the pattern splits it;
* a ``Split`` on a pattern that drops white space: the same runs without the space;
* anything else: the whole text.
"""

from __future__ import annotations

import json
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as the tokenizers' patterns know it (Unicode White_Space).
WS = "\t-\r \x85\xa0  -     　"
#: Letters that every Unicode version knows and that stay letters when lower-cased (so not U+0130), and ASCII punctuation without the apostrophe.
LETTERS, PUNCT = "A-Za-zÀ-ÖØ-öø-įı-ſ", "!-&(-/:-@\\[-`{-~"
BYTE_LEVEL_CHUNK = re.compile(
    f" ?[{LETTERS}]+(?=[{PUNCT}{WS}]|\\Z)| ?[{PUNCT}]+(?=[{WS}{LETTERS}]|\\Z)| ?[^{WS}]+"
    f"|[{WS}]+(?![^{WS}])|[{WS}]+")
WORD_CHUNK = re.compile(
    f"[{LETTERS}]+(?=[{PUNCT}{WS}]|\\Z)|[{PUNCT}]+(?=[{WS}{LETTERS}]|\\Z)|[^{WS}]+")
RUN_CHUNKS = re.compile(WORD_CHUNK.pattern + "|\n")
#: Chunks that are one pre-token for certain and change under no normalisation but lower-casing.
ONE_PRETOKEN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
CACHE_ENTRIES = 600_000
LONG_TEXT, STEP = 2_000_000, 200_000


class ChunkEncoder:
    """``encode(text)`` -> ids as little-endian unsigned bytes of ``width`` bytes each."""

    def __init__(self, path: str, width: int = 4, cache_entries: int = CACHE_ENTRIES):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            pre = json.load(f).get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers", [pre])
        self.pattern, self.lower = None, False
        if steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex", True) \
                and not steps[0].get("add_prefix_space"):
            self.pattern = BYTE_LEVEL_CHUNK
        elif steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert") \
                and "\\s" in steps[0]["pattern"].get("Regex", ""):
            self.pattern, self.lower = WORD_CHUNK, True
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None
        self.marks = special
        self.width, self.dtype, self.limit = width, f"<u{width}", cache_entries
        self.cache: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        # the byte-level alphabet, as the library's own pre-tokenizer spells single bytes
        from tokenizers.pre_tokenizers import ByteLevel
        alphabet = sorted(ByteLevel.alphabet(), key=ord)
        plain = [c for c in alphabet if ord(c) < 256]
        shifted = iter(c for c in alphabet if ord(c) >= 256)
        self.letters = {b: (chr(b) if chr(b) in plain else next(shifted)) for b in range(256)}

    def one(self, chunk: str) -> list[int]:
        """Ids of a chunk that is one pre-token, straight from the model."""
        text = chunk.lower() if self.lower else chunk
        if not (self.lower and text.isascii()):  # ASCII letters stand for themselves in the byte-level alphabet
            text = text.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(text)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _learn(self, missing) -> None:
        if len(self.cache) + len(missing) > self.limit:
            self.cache.clear()
        todo = []
        for c in missing:
            if ONE_PRETOKEN.fullmatch(c):
                self.cache[c] = array("I", self.one(c)).tobytes() if self.width == 4 else \
                    np.array(self.one(c), self.dtype).tobytes()
            else:
                todo.append(c)
        for i in range(0, len(todo), 4096):
            part = todo[i:i + 4096]
            self.cache.update(zip(part, self._ids(part)))

    def _join(self, chunks: list[str]) -> bytes:
        get = self.cache.__getitem__
        try:
            return b"".join(map(get, chunks))
        except KeyError:
            pass
        self._learn({c for c in chunks if c not in self.cache})
        try:
            return b"".join(map(get, chunks))
        except KeyError:  # the cache was cleared, and some of the known chunks with it
            self._learn({c for c in chunks if c not in self.cache})
            return b"".join(self.cache[c] if c in self.cache else self._ids([c])[0] for c in chunks)

    def _plain(self, text: str) -> bytes:
        if self.pattern is None:
            return self._ids([text])[0]
        if len(text) <= LONG_TEXT:
            return self._join(self.pattern.findall(text))
        runs = (m.group() for m in self.pattern.finditer(text))
        out = []
        while part := list(islice(runs, STEP)):
            out.append(self._join(part))
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(mark in text for mark in self.marks):
            return b"".join(self._ids([p])[0] if p in self.marks else self._plain(p)
                            for p in self.special.split(text) if p)
        return self._plain(text)

    def _runs(self, runs: list[str]) -> list[bytes]:
        """Ids of runs without ASCII white space."""
        found = list(map(self.cache.get, runs))
        missing = [i for i, ids in enumerate(found) if ids is None]
        text = "\n".join([runs[i] for i in missing])
        if any(mark in text for mark in self.marks):
            for i in missing:
                found[i] = self.encode(runs[i])
            return found
        for k in range(0, len(missing), STEP):
            part = missing[k:k + STEP]
            chunks = RUN_CHUNKS.findall("".join([runs[i] + "\n" for i in part]))
            self.cache["\n"] = b""
            ids = list(map(self.cache.get, chunks))
            new = {c for c, known in zip(chunks, ids) if known is None}
            if new:
                self._learn(new)
                ids = [self.cache[c] if known is None else known for c, known in zip(chunks, ids)]
            joined = b"".join(ids)
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            ends = ends[np.fromiter(map("\n".__eq__, chunks), bool, len(chunks))].tolist()
            for i, a, b in zip(part, [0, *ends], ends):
                found[i] = joined[a:b]
        return found

    def encode_column(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, with ``end`` after each text, and how many each text has with it.

        Where the tokenizer drops white space, the column's different runs without ASCII white space are looked up once
        each, and the ids are put together for the column as a whole.
        """
        mark = int(end).to_bytes(self.width, "little")
        if self.pattern is not WORD_CHUNK or any(re.search(r"\s", m) for m in self.marks) \
                or (pc.max(pc.binary_length(texts)).as_py() or 0) > LONG_TEXT:
            each = [self.encode(text.as_py()) + mark for text in texts]
            return np.frombuffer(b"".join(each), self.dtype), np.array([len(e) // self.width for e in each], np.int64)
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        runs = split.flatten().dictionary_encode()
        found = self._runs(runs.dictionary.to_numpy(zero_copy_only=False).tolist()) + [mark]
        ids = np.frombuffer(b"".join(found), self.dtype)
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        begin = np.cumsum(size) - size
        stops = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)
        code = np.insert(runs.indices.to_numpy().astype(np.int64), stops, len(found) - 1)
        many = size[code]
        ends = np.cumsum(many)
        at = np.repeat(begin[code] - (ends - many), many)
        at += np.arange(len(at))
        return ids[at], np.diff(ends[stops + np.arange(len(stops))], prepend=0)


_encoders: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, width: int = 4) -> ChunkEncoder:
    """The worker process's encoder of a file; kept between tasks."""
    key = (path, width)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, width)
    return _encoders[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
