"""SentencePiece BPE: exact encoding by backtracking, and decoding.

A text is a valid encoding exactly when every two neighbouring tokens are: when merging their
joined text from its characters gives the same two tokens again. So no merge queue over the whole
text is needed. At each place the longest piece (found by one Aho-Corasick pass) is tried that is
compatible with the token before it; a place from which no piece leads on is marked in a bit field,
so that it is tried only once, and the last token is taken back.

No merge spans a border that lies inside no piece. The model's pieces contain the space mark only
at their start or as runs, so words are encoded one by one and kept in a bounded memo.

Defined cases: a null or empty text has no ids but the end id and decodes to an empty text;
characters outside the vocabulary become byte pieces (or the unknown id if the model has none);
repeated rows and ties need nothing special; further input columns are not read; an empty table
gives an empty table.
"""

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import Memo, small_batches, texts

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class Codec:
    """One model, as read from its file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or normal.name != "identity" \
                or normal.remove_extra_whitespaces or not normal.add_dummy_prefix:
            raise ValueError("only BPE models with identity normalisation are supported")
        pieces = model.pieces
        self.unknown = next(i for i, p in enumerate(pieces) if p.type == _UNKNOWN)
        self.end = next((i for i, p in enumerate(pieces) if p.piece == "</s>"), self.unknown)
        self.ids = {p.piece: i for i, p in enumerate(pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in pieces if p.type == _NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(pieces) if p.type == _BYTE}
        surface = model.trainer_spec.unk_surface.encode()
        self.surface = [surface if p.type == _UNKNOWN else b"" if p.type == _CONTROL
                        else bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE
                        else p.piece.replace(SPACE, " ").encode() for p in pieces]
        self.silent = {i for i, p in enumerate(pieces) if p.type == _CONTROL}
        self.is_byte = [p.type == _BYTE for p in pieces]
        self.opens = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        inner = [p for p in self.ids if SPACE in p[1:]]
        if any(p.strip(SPACE) for p in inner):
            raise ValueError("pieces that span words are not supported")
        self.find = ahocorasick.Automaton()
        for piece in self.ids:
            self.find.add_word(piece, len(piece))
        self.find.make_automaton()
        #: for pieces of several characters, the length of the next shorter piece they begin with
        self.shorter = {p: next(k for k in range(len(p) - 1, 0, -1) if k == 1 or p[:k] in self.ids)
                        for p in self.ids if len(p) > 1}
        #: neighbours inside some piece; between any other two characters nothing merges
        self.inside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.words = Memo(self._encode_word, 200_000)
        self.pairs = Memo(self._is_stable, 200_000)

    # --- encoding -----------------------------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """The defining procedure, for short texts: best-scored pair first, leftmost on ties."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _is_stable(self, pair: tuple[str, str]) -> bool:
        """Whether the two tokens stay as they are when their text is merged anew."""
        left, right = pair
        return self.merge(left + right) == ([left, right] if left else [right])

    def _tokens(self, text: str) -> list[str]:
        size = len(text)
        longest = list(range(1, size + 1))  # by start; one character always fits
        for last, length in self.find.iter(text):
            longest[last - length + 1] = last + 1
        tokens, failed, pairs, shorter = [], 0, self.pairs, self.shorter
        at, end, before = 0, longest[0], ""
        while at < size:
            token = text[at:end]
            if not (failed and failed >> end & 1) and pairs[before, token]:
                tokens.append(token)
                at, before = end, token
                if at < size:
                    end = longest[at]
            elif length := shorter.get(token):
                end = at + length
            else:  # nothing leads on from here: take the last token back and make it shorter
                failed |= 1 << at
                token = tokens.pop()
                at, end = at - len(token), at
                before = tokens[-1] if tokens else ""
        return tokens

    def _encode_word(self, word: str) -> tuple[int, ...]:
        inside, cuts = self.inside, ()
        if not word[1:].isalpha():  # within letters a cut would seldom be found
            cuts = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in inside]
        if cuts:
            spans = zip([0, *cuts], [*cuts, len(word)])
            return tuple(chain.from_iterable([self.words[word[a:b]] for a, b in spans]))
        out = []
        for token in self._tokens(word):
            found = self.ids.get(token)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out.extend(self.bytes[b] for b in token.encode())
            else:
                out.append(self.unknown)
        return tuple(out)

    def _split(self, text: str) -> list[str]:
        """Words with the space marks before them."""
        parts = text.replace(SPACE, " ").split(" ")
        if "" not in parts:
            return [SPACE + part for part in parts]
        words, marks = [], ""
        for part in parts:  # runs of spaces stay with the word after them
            marks += SPACE
            if part:
                words.append(marks + part)
                marks = ""
        return words + [marks] * bool(marks)

    def encode(self, text: str, end: bool = True) -> array:
        ids = array("i")
        if text:
            ids.extend(chain.from_iterable(map(self.words.__getitem__, self._split(text))))
        if end:
            ids.append(self.end)
        return ids

    # --- decoding -----------------------------------------------------------------------------

    def decode(self, ids) -> str:
        surface = self.surface
        raw = b"".join(map(surface.__getitem__, ids))
        first = next((i for i in ids if i not in self.silent), None)
        try:
            # a control piece within the text parts the byte pieces around it
            text = raw.decode() if self.silent.isdisjoint(ids[:-1]) else "".join(self._runs(ids))
        except UnicodeDecodeError:
            text = "".join(self._runs(ids))
        return text[1:] if first in self.opens else text

    def _runs(self, ids) -> Iterator[str]:
        """Runs of byte pieces that are no UTF-8: each stray byte is one replacement mark."""
        run = bytearray()
        for i in chain(ids, [None]):
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        yield run[at:at + size].decode()
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    yield "�"
                at += size
            run.clear()
            if i is not None:
                yield self.surface[i].decode()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """Built once in each Python worker."""
    return Codec(path)


def _list_array(rows: list[array]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = array("i")
    for row in rows:
        values += row
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(values, np.int32)))


def encode(docs: DataFrame, model: str, end: bool = True, id_col: str = "doc_id",
           text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` of every whole text; with ``decoded`` also the text they decode to.

    ``model`` is the path of a SentencePiece BPE model, the same on every worker.
    """
    small_batches(docs.sparkSession)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>" \
        + ", decoded string" * decoded

    def run(batches):
        tool = codec(model)
        for batch in batches:
            rows = [tool.encode(t, end) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), _list_array(rows)]
            if decoded:
                columns.append(pa.array([tool.decode(r) for r in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)])

    return texts(docs, id_col, text_col).mapInArrow(run, schema)


def decode(coded: DataFrame, model: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from a column of id arrays; null arrays decode to empty texts."""
    small_batches(coded.sparkSession)

    def run(batches):
        tool = codec(model)
        for batch in batches:
            rows = [tool.decode(r or ()) for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())],
                                             ["doc_id", "text"])

    kind = coded.schema[id_col].dataType.simpleString()
    return coded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"doc_id {kind}, text string")
