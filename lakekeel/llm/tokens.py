"""Token ids of a byte-level BPE vocabulary, word by word with a memory of words met before."""

from __future__ import annotations

import functools
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from lakekeel.llm.shared import whole_texts

#: Words a worker remembers; the memory starts anew when it is full.
REMEMBERED = 400_000
#: The split before the merges, with Unicode's own white space.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: White space beside white space; elsewhere a text can be cut before any blank and around any line end. Other white
#: space at an end of a word counts as such too.
_RUNS = ("  ", "\n\n", " \n", "\n ")


def _byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Words(dict):
    """Text between blanks to its ids as little-endian 32-bit bytes, with a blank before it or without.

    A word with white space at an end is a KeyError, since it can't be taken alone.
    """

    def __init__(self, encoding: tiktoken.Encoding, before: str):
        self.encoding, self.before = encoding, before

    def __missing__(self, word: str) -> bytes:
        if word[:1].isspace() or word[-1:].isspace():
            raise KeyError(word)
        if len(self) >= REMEMBERED:
            self.clear()
        found = self.encoding.encode_ordinary(self.before + word)
        self[word] = ids = struct.pack(f"<{len(found)}I", *found)
        return ids


@functools.cache
def _content(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@functools.cache
def _vocabulary(path: str) -> tuple[tiktoken.Encoding, _Words, _Words, bytes]:
    content = _content(path)
    added = {x["content"] for x in content.get("added_tokens", [])}
    byte = _byte_of_char()
    ranks = {bytes(byte[c] for c in word): i for word, i in content["model"]["vocab"].items() if word not in added}
    encoding = tiktoken.Encoding("words", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
    line_end = np.array(encoding.encode_ordinary("\n"), "<u4").tobytes()
    return encoding, _Words(encoding, ""), _Words(encoding, " "), line_end


def encode(text: str, path: str) -> bytes:
    """Ids of a text as little-endian 32-bit bytes, without special tokens; their strings are ordinary text."""
    encoding, first, later, line_end = _vocabulary(path)
    if not any(run in text for run in _RUNS):
        try:
            lines = (line.split(" ") for line in text.split("\n"))
            return line_end.join([first[words[0]] + b"".join(map(later.__getitem__, words[1:])) for words in lines])
        except KeyError:
            pass
    return np.array(encoding.encode_ordinary(text), "<u4").tobytes()


@functools.cache
def _added(path: str) -> tuple[re.Pattern | None, dict[str, bytes]]:
    """A pattern of the added tokens with the blanks they take, longest first, and the id of each."""
    tokens = sorted(_content(path).get("added_tokens", []), key=lambda x: -len(x["content"]))
    forms = []
    for x in tokens:
        form = f"({re.escape(x['content'])})"
        form = rf"(?<!\w){form}(?!\w)" if x.get("single_word") else form
        forms.append((r"\s*" if x.get("lstrip") else "") + form + (r"\s*" if x.get("rstrip") else ""))
    return re.compile("|".join(forms)) if forms else None, {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in tokens}


def encode_added(text: str, path: str) -> bytes:
    """Ids of a text as the library gives them by default: strings of added tokens are their ids, whatever lies between is ordinary text."""
    pattern, ids = _added(path)
    if not any(token in text for token in ids):
        return encode(text, path)
    out, at = [], 0
    for token in pattern.finditer(text):
        out += [encode(text[at : token.start()], path) if token.start() > at else b"", ids[token[token.lastindex]]]
        at = token.end()
    if not at:
        return encode(text, path)
    return b"".join(out) + (encode(text[at:], path) if at < len(text) else b"")


PIECES = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: each document's ids, cut into pieces of ``capacity`` from its end.

    Strings of added tokens in a text get their ids, as by the library.
    Only longer documents are cut, and only their first piece may be shorter.
    NULL and empty texts have the end id alone, and without one no piece.
    Repeated rows and NULL ids are documents like any other.
    """
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    ids = encode_added(text.decode("utf-8", "replace"), path) + end
                    total, start, piece = len(ids) // 4, 0, 0
                    stop = (total - 1) % capacity + 1 if total else 0
                    while start < total:
                        for name, value in zip(out, (doc_id, piece, start, stop - start, ids[4 * start : 4 * stop]), strict=True):
                            out[name].append(value)
                        start, stop, piece = stop, stop + capacity, piece + 1
                yield pa.RecordBatch.from_pydict(out, pa.schema([
                    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                ]))

    return whole_texts(docs, id_col, text_col).mapInArrow(run, PIECES)
