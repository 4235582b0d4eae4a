"""SentencePiece models run by the tokenizers library.

The model protobuf is parsed and its parts are rebuilt: the normaliser, the
metaspace marker, unigram scores or the merges of a BPE model, and byte fallback.
Batches are encoded by several threads. Every distinct word that a task meets is
also encoded by the sentencepiece library, so a text whose ids would differ is seen.

A word here is a run of markers and what follows up to the next one or to the line end. Where no
piece of the model has a marker behind another character, or a line end, pieces never cross
the words, and a text has the ids of its words; another model is encoded text by text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from framestore.llm.batches import id_and_text, id_type, slices
from framestore.llm.packing import vocabulary_file
from framestore.llm.registry import query, table
from framestore.llm.vocabulary import WordIds

MARK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


def parse_model(data: bytes):
    """The model's protobuf message."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(data)
    return model


def merges(pieces: list[tuple[str, float]]) -> list[tuple[str, str]]:
    """The pairs of pieces that make another piece, best score first."""
    place = {p: i for i, (p, _) in enumerate(pieces)}
    found = []
    for piece, score in pieces:
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in place and right in place:
                found.append((-score, place[left], place[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def rebuild(model):
    """A tokenizer of the tokenizers library for a parsed unigram or BPE model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    spec, trained = model.normalizer_spec, model.trainer_spec
    names = [(p.piece, p.score) for p in model.pieces]
    fallback = any(p.type == _BYTE for p in model.pieces)
    if trained.model_type == _UNIGRAM:
        core = models.Unigram(names, unk_id=trained.unk_id, byte_fallback=fallback)
    elif trained.model_type == _BPE:
        plain = [(p.piece, p.score) for p in model.pieces if p.type in (_NORMAL, _USER)]
        core = models.BPE(
            {n: i for i, (n, _) in enumerate(names)}, merges(plain), unk_token=names[trained.unk_id][0],
            fuse_unk=True, byte_fallback=fallback,
        )
    else:
        raise ValueError("Only unigram and BPE models can be rebuilt")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(spec.precompiled_charsmap)] if spec.precompiled_charsmap else []
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if splits_at_marks(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+"), "isolated")
    users = [AddedToken(p.piece, normalized=True, special=False) for p in model.pieces if p.type == _USER]
    if users:
        tokenizer.add_tokens(users)
    tokenizer.decoder = decoders.Sequence([
        decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
        *([decoders.Strip(" ", 1, 0)] if spec.add_dummy_prefix else []),
    ])
    return tokenizer


def splits_at_marks(model) -> bool:
    """True if no piece reaches over the start of a word or over a line end."""
    plain = [p.piece for p in model.pieces if p.type in (_NORMAL, _USER)]
    return not any(MARK in p.lstrip(MARK) or "\n" in p for p in plain)


class Pieces:
    """Encoding and decoding with one model, in one Python worker."""

    def __init__(self, data: bytes, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        self.model, self.threads = parse_model(data), threads
        self.tokenizer = rebuild(self.model)
        self.judge = sentencepiece.SentencePieceProcessor(model_proto=data)
        spec = self.model.normalizer_spec
        # Words can be looked up if they normalise to themselves.
        self.by_word = (
            splits_at_marks(self.model) and spec.add_dummy_prefix and not spec.precompiled_charsmap
            and not spec.remove_extra_whitespaces and not any(p.type == _USER for p in self.model.pieces)
        )
        self.differs: set[str] = set()
        if self.by_word:
            self.words = WordIds(self._encode, "\n", "\n", "\n", self._compare)
            self.newline = np.asarray(self.words.mark, dtype="<u4").tobytes()
        # What an id stands for; a byte piece is its byte.
        self.bytes_of = [
            bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE else b"" if p.type == _CONTROL
            else self.model.trainer_spec.unk_surface.encode() if p.type == _UNKNOWN else p.piece.replace(MARK, " ").encode()
            for p in self.model.pieces
        ]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _compare(self, words: list[list[str]], texts: list[str], ids: list[np.ndarray]) -> None:
        """Note the words that sentencepiece gives other ids."""
        for group, mine, theirs in zip(words, ids, self.judge.encode(texts, num_threads=self.threads)):
            if not np.array_equal(mine, theirs):
                lines = [f"\n{w}" for w in group]
                pairs = zip(group, self._encode(lines), self.judge.encode(lines, num_threads=self.threads))
                found = {w for w, a, b in pairs if a != b}
                # A difference that no word shows by itself counts against all of them.
                self.differs.update(found or group)

    _WORD = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")

    def split(self, text: str) -> list[str]:
        """Line ends, and words with the markers that they begin with."""
        return self._WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids of each text (unsigned 32-bit, little-endian), and whether sentencepiece gives the same."""
        if not self.by_word:
            ids = [np.asarray(x, dtype="<u4").tobytes() for x in self._encode(texts)]
            theirs = self.judge.encode(texts, num_threads=self.threads)
            return ids, [a == np.asarray(b, dtype="<u4").tobytes() for a, b in zip(ids, theirs)]
        split = [self.split(t) for t in texts]
        self.words.learn(w for s in split for w in s if w != "\n")
        known, differs = self.words.known, self.differs
        known["\n"] = self.newline
        same = [not differs or differs.isdisjoint(s) for s in split]
        return [b"".join([known[w] for w in s]) for s in split], same

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, markers as spaces, without the dummy prefix; broken bytes are U+FFFD."""
        text = b"".join([self.bytes_of[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model.normalizer_spec.add_dummy_prefix and text.startswith(" ") else text


_READY: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _READY:
        with open(path, "rb") as f:
            _READY[path] = Pieces(f.read())
    return _READY[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of `docs`: id, `ids`, `n_ids`, `ids_crc32`, `parity`, `round_trip`.

    `parity`: the ids are those of the sentencepiece library. `round_trip`: the
    decoded ids are the text, the marker character read as a space. Null and
    empty texts have no ids. Repeated rows are encoded one by one. An empty table
    gives no rows. Other columns are ignored. `path` must be readable on every executor.
    """
    path = path or vocabulary_file("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                ids, same = model.encode(texts)
                back = [model.decode(np.frombuffer(x, "<u4")) == t.replace(MARK, " ") for x, t in zip(ids, texts)]
                sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                flat = np.frombuffer(b"".join(ids), dtype="<i4")
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                        pa.array(sizes),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array(same),
                        pa.array(back),
                    ],
                    ["id", "ids", "n_ids", "ids_crc32", "parity", "round_trip"],
                )

    schema = f"id {id_type(docs, id_col)}, ids array<int>, n_ids bigint, ids_crc32 bigint, parity boolean, round_trip boolean"
    rows = id_and_text(docs, id_col, text_col).drop("row").mapInArrow(run, schema)
    return rows.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Columns id and `text`: the text of `ids_col` (null or empty: an empty text)."""
    path = path or vocabulary_file("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for batch in batches:
            texts = [model.decode(np.asarray(x or [], dtype=np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return rows.mapInArrow(run, f"id {id_type(encoded, id_col)}, text string").withColumnRenamed("id", id_col)


@query()
def op1_sentencepiece(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"))
