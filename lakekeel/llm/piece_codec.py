"""Encoding and decoding with a SentencePiece BPE model, by prefix tables.

For each prefix of a word there is one last token: of the vocabulary's matches
that end there (found by an automaton) the one that is compatible with the
last token of the prefix before it. Two tokens are compatible if merging their
joint text by score gives just these two. The table holds a token per prefix,
and the ids are read off it backwards. Words are remembered, and so are pairs.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from lakekeel.llm.shared import whole_texts

#: Words and pairs of tokens that a worker remembers; a full memory starts anew.
REMEMBERED_WORDS, REMEMBERED_PAIRS = 400_000, 1_000_000
SPACE = "▁"
#: Characters up to which neighbours are looked through for each merge.
SHORT = 32


class _Pairs(dict):
    """Whether two pieces stay apart when their joint text is merged."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores

    def merged(self, text: str) -> list[str]:
        """Pieces of a text by merging: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merged_long(self, text: str) -> list[str]:
        """The same for a text of any length: neighbours wait in a queue by score and place."""
        n = len(text)
        parts, before, after = list(text), list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[float, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right >= 0:
                score = self.scores.get(parts[left] + parts[right])
                if score is not None:
                    heapq.heappush(queue, (-score, left, len(parts[left]), len(parts[right])))

        for i in range(n):
            offer(i)
        while queue:
            _, left, own, other = heapq.heappop(queue)
            right = after[left] if parts[left] else -1
            if right < 0 or len(parts[left]) != own or len(parts[right]) != other:
                continue  # one of them has been merged since
            parts[left] += parts[right]
            parts[right] = ""
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [p for p in parts if p]

    def __missing__(self, pair: tuple[str, str]) -> bool:
        if len(self) >= REMEMBERED_PAIRS:
            self.clear()
        first, last = pair
        self[pair] = apart = self.merged(first + last) == ([first, last] if first else [last])
        return apart


class Model:
    """The vocabulary of a BPE model without normalisation rules, with byte fallback."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown, self.end = model.unk_id(), model.eos_id()
        self.content = {i: piece.encode() for piece, i in self.ids.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.content |= {i: b"" for i in ids if model.is_control(i)} | {self.unknown: " ⁇ ".encode()}
        self.content = {b"%d" % i: text for i, text in self.content.items()}
        self.pairs = _Pairs(self.scores)
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        # Whether a text can be cut before each run of blanks and around line ends: no piece lies across.
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in self.ids)
        self.beside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.first, self.later, self.parts = _Units(self, ""), _Units(self, SPACE), {}

    def pieces(self, unit: str) -> list[str]:
        """The pieces of a unit by its prefix table."""
        if SPACE * 2 in unit:  # runs of blanks have equal scores, for which a prefix's last piece isn't unique
            return self.pairs.merged(unit) if len(unit) <= SHORT else self.pairs.merged_long(unit)
        last: list[str] = [""] * (len(unit) + 1)
        for end, piece in self.automaton.iter(unit):
            start = end + 1 - len(piece)
            if not last[end + 1] and (not start or last[start] or self._gap(unit, start, last)) and self.pairs[last[start], piece]:
                last[end + 1] = piece
        found, end = [], len(unit)
        while end:
            piece = last[end] or unit[end - 1]
            found.append(piece)
            end -= len(piece)
        return found[::-1]

    def _gap(self, unit: str, start: int, last: list[str]) -> bool:
        """A character that no piece ends with is a piece of its own."""
        last[start] = unit[start - 1]
        return True

    def text_ids(self, unit: str) -> bytes:
        """Ids of a unit, cut further between characters that no piece has side by side."""
        if len(self.parts) >= REMEMBERED_WORDS:
            self.parts.clear()
        cuts = [0, *(i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in self.beside), len(unit)]
        out = []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            part = unit[start:stop]
            ids = self.parts.get(part)
            if ids is None:
                ids = self.parts[part] = self._part_ids(part)
            out.append(ids)
        return b"".join(out)

    def _part_ids(self, unit: str) -> bytes:
        out = []
        for piece in self.pieces(unit):
            number = self.ids.get(piece)
            if number is not None:
                out.append(number)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return b"".join(b" %d" % i for i in out)

    def encode(self, text: str) -> bytes:
        """Ids in decimal, joined by one blank, the end id last."""
        if not text:
            return b"%d" % self.end
        if not self.cuts:
            ids = self.text_ids(SPACE + text.replace(" ", SPACE))
        elif "  " in text or text[0] == " " or SPACE in text:
            marked = SPACE + text.replace(" ", SPACE)
            ids = b"".join(map(self.first.__getitem__, re.findall(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+", marked)))
        else:
            out = []
            first = self.later
            for line in text.split("\n"):
                words = line.split(" ")
                out.append(first[words[0]])
                out.extend(map(self.later.__getitem__, words[1:]))
                out.append(self.first["\n"])
                first = self.first
            ids = b"".join(out[:-1])
        return ids[1:] + b" %d" % self.end

    def decode(self, ids: bytes) -> str:
        whole = b"".join(map(self.content.__getitem__, ids.split()))
        text = whole.decode("utf-8", "replace")
        return text.removeprefix(SPACE).replace(SPACE, " ")


class _Units(dict):
    """Text without blanks inside to its ids, each after a blank."""

    def __init__(self, model: Model, before: str):
        self.model, self.before = model, before

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = ids = self.model.text_ids(self.before + word)
        return ids


@functools.cache
def model(path: str) -> Model:
    return Model(path)


def piece_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)``: the ids of each whole text and the end id, in decimal, joined by one blank.

    NULL and empty texts have the end id alone. Repeated rows and NULL ids are
    encoded like others; other columns are ignored. Blanks are kept as they
    are, so the model must be one without normalisation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                ids = [model(path).encode(t.decode("utf-8", "replace")) for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([i.count(b" ") + 1 for i in ids], pa.int64()), pa.array(ids).cast(pa.string())],
                    names=["doc_id", "n_tokens", "ids"],
                )

    return whole_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids string")


def piece_decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, text)``: the text that the ids of ``piece_encode`` stand for; NULL ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                texts = [model(path).decode((i or "").encode()) for i in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "text"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids string, text string")
