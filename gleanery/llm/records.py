"""Token ids as length-delimited binary records with an offset index.

A record is
    length    unsigned 64-bit, little-endian: bytes of the payload
    check     unsigned 32-bit, little-endian: masked CRC-32 of the 8 length bytes
    payload   doc_id (signed 64-bit; records of null ids have flag 1), flag (one byte), then ids
              as little-endian unsigned integers of `width` bytes (2 if the vocabulary allows, else 4)
    check     unsigned 32-bit, little-endian: masked CRC-32 of the payload
    end       one byte, 0x0A
where masking rotates a checksum right by 15 bits and adds 0xA282EAD8, so that a
payload that itself holds checksums does not weaken them.

Files are written by Spark's text sink, one record as one value and the end byte
as its line separator, so that any file system and its commit protocol serve: a
task that fails leaves nothing behind. Shards are in ascending doc_id order, and
so are the records in them. The index, a Parquet table beside the shards, has
the shard, offset, length and number of ids of every record, for shuffled reads.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import model_bytes

END_ID = 1
#: Words and pieces that a worker remembers the ids of; when they are full the words go, and the pieces if they are most of them.
MEMORY_WORDS = 600_000
_TOKENIZERS: dict = {}
#: Lower-case letters of Latin-1 between printable ASCII characters that are neither letters,
#: digits nor apostrophes: no normalisation changes them, and each run is one piece.
_OTHER = r"([!-&(-/:-@\[-`{-~]*)"
_MARKS = bytes(b for b in range(33, 127) if re.match(_OTHER[1:-2], chr(b)))
_PLAIN = re.compile(_OTHER + "([a-z\u00df-\u00f6\u00f8-\u00ff]+)" + _OTHER).fullmatch
#: The printable stand-ins of byte-level vocabularies: the other bytes follow from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_REST = [b for b in range(256) if b not in _PRINTABLE]
_STAND_IN = {b: chr(b) if b in _PRINTABLE else chr(256 + _REST.index(b)) for b in range(256)}


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    payload = struct.pack("<qB", doc_id or 0, doc_id is None) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload,
                     struct.pack("<I", masked(payload)), b"\n"))


HEAD, TAIL = 12, 5


def parse(data: bytes, at: int = 0):
    """(offset, length of the record, doc_id, ids) of every record from `at`; raises on damage."""
    while at < len(data):
        if len(data) < at + HEAD:
            raise ValueError(f"truncated record at {at}")
        size, check = struct.unpack_from("<QI", data, at)
        if masked(data[at:at + 8]) != check:
            raise ValueError(f"damaged length at {at}")
        end = at + HEAD + size
        if len(data) < end + TAIL or data[end + TAIL - 1] != 10:
            raise ValueError(f"truncated record at {at}")
        payload = data[at + HEAD:end]
        if masked(payload) != struct.unpack_from("<I", data, end)[0]:
            raise ValueError(f"damaged payload at {at}")
        doc_id, missing = struct.unpack_from("<qB", payload)
        yield at, HEAD + size + TAIL, None if missing else doc_id, payload[9:]
        at = end + TAIL


class _Known(dict):
    """Ids by word; what is not in it is found by `find`, which may note it."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, word: bytes) -> bytes:
        return self.find(word)


class _WordIds:
    """Ids of words by a tokenizer whose pieces never reach over ASCII white space.

    Most new words are Latin-1 letters between printable ASCII characters: their
    pieces are known without the normaliser and the splitter, and go to the
    tokenizer's model directly. All others take the tokenizer's whole way. With
    literal, special tokens spelt out in a text are split like other text, else
    they get their own id, as in the library.
    """

    def __init__(self, model: bytes, literal: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode())
        self.tokenizer.encode_special_tokens = literal
        self.model = self.tokenizer.model
        self.width, self.packs = None, []
        self.known, self.pieces = _Known(self._word), _Known(self._piece)

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        ids = [x.id for x in self.model.tokenize(text if piece.isascii() else "".join(map(_STAND_IN.__getitem__, piece)))]
        data = self.packs[len(ids)](*ids) if len(ids) < len(self.packs) else np.array(ids, self.width).tobytes()
        self.pieces[piece] = data
        return data

    def _word(self, word: bytes) -> bytes:
        letters = word.strip(_MARKS)
        if letters.isalpha():  # ASCII letters between marks, as most words are
            before, _, after = word.partition(letters)
            letters = letters.lower()
        else:
            plain = _PLAIN(word.decode().lower())
            before, letters, after = [x.encode() for x in plain.groups()] if plain else (b"", b"", b"")
        if not letters or b"<|" in word:
            ids = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, self.width).tobytes()
            self.known[word] = ids
            return ids
        pieces, ids = len(self.pieces), self.pieces[letters]
        if before:
            ids = self.pieces[before] + ids
        if after:
            ids += self.pieces[after]
        # Most words with a new piece never come again: its ids are noted, those of the word the next time.
        if len(self.pieces) == pieces:
            self.known[word] = ids
        return ids

    def encode(self, texts: list[str | None], width: str) -> list[bytes]:
        if width != self.width:
            self.width = width
            self.packs = [struct.Struct(f"<{n}{'H' if width == '<u2' else 'I'}").pack for n in range(64)]
            self.known.clear()
            self.pieces.clear()
        if len(self.known) + len(self.pieces) > MEMORY_WORDS:
            self.known.clear()  # words are soon put together again from their pieces
            if len(self.pieces) > MEMORY_WORDS * 2 // 3:
                self.pieces.clear()
        end, ids = np.array([END_ID], width).tobytes(), self.known.__getitem__
        return [b"".join(map(ids, (t or "").encode().split())) + end for t in texts]


def _word_ids(model: bytes, width: str) -> _WordIds:
    key = (zlib.crc32(model), len(model), width)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = _WordIds(model, literal=False)
    return _TOKENIZERS[key]


def _framed(doc_id: Column, text: Column, model, width: str) -> Column:
    @F.pandas_udf("binary")
    def encode(doc_ids: pd.Series, texts: pd.Series) -> pd.Series:
        coder, frames = _word_ids(model.value, width), []
        values, missing = doc_ids.tolist(), doc_ids.isna().tolist()
        for at in range(0, len(texts), 256):
            for i, ids in enumerate(coder.encode(texts[at:at + 256].tolist(), width), at):
                frames.append(frame(None if missing[i] else int(values[i]), ids)[:-1])
        return pd.Series(frames, dtype=object)

    return encode(doc_id, text)


def write(docs: DataFrame, folder: str, model_path: str, shards: int | None = None) -> None:
    """Write folder/shards and folder/index from docs (doc_id, text), ids ended by END_ID.

    A null text counts as empty; null ids come first; rows that repeat a doc_id
    follow one another; other columns are not read; an empty table gives no
    record. model_path names a tokenizers file on the driver; ids are written
    with two bytes each if its vocabulary has at most 65,536 entries.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    data = model_bytes(model_path)
    width = "<u2" if Tokenizer.from_str(data.decode()).get_vocab_size() <= 1 << 16 else "<u4"
    model = spark.sparkContext.broadcast(data)
    # Dealt before the encoding: the range exchange samples its input, which then runs twice.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = rows.repartitionByRange(shards, "doc_id") if shards else rows.repartitionByRange("doc_id")
    coded = dealt.sortWithinPartitions("doc_id", "text").select(
        _framed(F.col("doc_id"), F.col("text"), model, width).alias("frame"))
    coded.select(F.col("frame").cast("string").alias("value")).write.option(
        "lineSep", "\n").text(f"{folder}/shards")
    _scan(spark, folder, width).drop("place").write.parquet(f"{folder}/index")
    spark.createDataFrame([(width,)], "width string").write.json(f"{folder}/meta")


def _width(spark, folder: str) -> str:
    return spark.read.schema("width string").json(f"{folder}/meta").first()["width"]


_PLACE = "shard string, place long, offset long, length long, doc_id long, n_tokens long"


def _scan(spark, folder: str, width: str, value: str | None = None, of=None) -> DataFrame:
    """The place, doc_id and number of ids of every record, verified, and of(ids) as one more column."""
    names = [c.split()[0] for c in _PLACE.split(", ")] + ([value.split()[0]] if value else [])

    def read(batches):
        size = np.dtype(width).itemsize
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                rows = []
                for place, (offset, length, doc_id, ids) in enumerate(parse(data)):
                    row = (path, place, offset, length, doc_id, len(ids) // size)
                    rows.append((*row, of(np.frombuffer(ids, width).astype("<u4").tobytes())) if of else row)
                    if len(rows) == 256:
                        yield _batch(rows, names)
                        rows = []
                yield _batch(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/shards")
    return files.where("length > 0").select("path", "content").mapInPandas(
        read, f"{_PLACE}, {value}" if value else _PLACE).withColumn(
        "shard", F.regexp_extract("shard", r"part-(\d+)", 1).cast("int"))


def _batch(rows, names) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def records(spark, folder: str) -> DataFrame:
    """shard, place, offset, length, doc_id, n_tokens, ids (unsigned 32-bit) of every record, verified."""
    return _scan(spark, folder, _width(spark, folder), "ids binary", lambda ids: ids)


def digests(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, read from the files.

    start adds the ids of all shards before (from one row per shard) to those
    before in the shard, so that no task sees more than a shard.
    """
    every = _scan(spark, folder, _width(spark, folder), "ids_crc32 long", zlib.crc32).select(
        "shard", "place", "doc_id", "n_tokens", "ids_crc32")
    index = spark.read.parquet(f"{folder}/index")
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("ids")).select(
        "shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    inside = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return every.join(shards, "shard").select(
        "doc_id", (F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens", "ids_crc32")


def fetch(spark, folder: str, wanted: DataFrame) -> DataFrame:
    """The records of wanted (doc_id), found by the index in any order."""
    index = spark.read.parquet(f"{folder}/index").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    return records(spark, folder).join(index.select("shard", "offset"), ["shard", "offset"])
