"""BPE encoding through a distinct-word table, and decoding through an id-to-piece join.

Texts are split into the tokenizer's words in Spark. Every chunk of texts (a few MB of
one partition) gives its distinct words, dealt by hash to buckets in packed, sorted
blocks: a bucket joins the blocks of all chunks, encodes each distinct word once and
answers every chunk with the ids of its words. The answers are joined to the chunk's
texts and the ids are set back by position. Decoding joins ids with the table of pieces
(a row per id, so its size is that of the tokenizer); this tokenizer has no decoder
step, so the library joins the pieces with single spaces.

Packed blocks keep the shuffle far below one row per word. A word that an answer lacks
(possible only if a recomputed partition deals its rows anew) is encoded on the spot, so
results never depend on the order of rows.

Defined results: null text is empty and has no tokens; equal rows give equal rows; an
empty table gives an empty frame; strings of special tokens inside texts become their
ids, as the library does by default.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes


# Fixed value: the word pattern of the tokenizer file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


class WordTokenizer:
    """Splits texts as the tokenizer file says and encodes single words."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or level["use_regex"] or spec["decoder"]:
            raise ValueError(f"{path}: another kind of tokenizer")
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        if split["pattern"]["Regex"] != PATTERN:
            raise ValueError(f"{path}: another pattern")
        # the same words by the standard library's classes; letters it sees otherwise are found by _agrees
        self.words_of = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\s\w]|_)+").findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("|".join(re.escape(t) for t in self.special)) if self.special else None
        self.letters = byte_letters()
        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
        # letters that this library's Unicode tables may see otherwise go the tokenizer's own way
        self.agreed: dict[str, bool] = {}
        odd = "".join(c for c in map(chr, range(128)) if not self._agrees(c))
        self.odd_ascii = re.compile(f"[{re.escape(odd)}]").search if odd else lambda t: None

    def _agrees(self, c: str) -> bool:
        ok = self.agreed.get(c)
        if ok is None:
            probe = f"a{c}a 1{c}1 -{c}- {c}{c}"
            normal = unicodedata.normalize("NFC", probe).replace("Σ", "σ").lower()
            theirs = re.sub(r"\s+", " ", self.tok.normalizer.normalize_str(probe))
            ok = self.agreed[c] = (re.sub(r"\s+", " ", normal) == theirs
                                   and self.words_of(normal) == [w for w, _ in self.split.pre_tokenize_str(normal)])
        return ok

    def words(self, text: str) -> list[str]:
        if self.special_re is not None and "<|" in text:
            out, at = [], 0
            for m in self.special_re.finditer(text):
                out += self._plain(text[at:m.start()])
                out.append(m[0])
                at = m.end()
            return out + self._plain(text[at:])
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            if self.odd_ascii(text):
                return self._own_words(text)
            return self.words_of(text.lower())
        if not all(map(self._agrees, set(text))):
            return self._own_words(text)
        # the tokenizer lower-cases letter by letter, without the rule for a final sigma
        return self.words_of(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _own_words(self, text: str) -> list[str]:
        return [w for w, _ in self.split.pre_tokenize_str(self.tok.normalizer.normalize_str(text))]

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        letters = self.letters
        return [t.id for t in self.model.tokenize("".join([letters[b] for b in word.encode("utf-8")]))]

    def pieces(self) -> list[str]:
        """The piece of each id."""
        n = self.tok.get_vocab_size(with_added_tokens=True)
        return [self.tok.id_to_token(i) for i in range(n)]


def tokenizer_at(path: str) -> WordTokenizer:
    """The tokenizer, loaded once in a Python worker."""
    kept = sys.modules.setdefault("_kept_tokenizers", types.ModuleType("_kept_tokenizers"))
    if path not in kept.__dict__:
        kept.__dict__[path] = WordTokenizer(path)
    return kept.__dict__[path]


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, list, list[bytes]]]:
    """(chunk number, ids, texts) of about ``chunk_bytes`` of text each."""
    base = TaskContext.get().partitionId() << 24
    no, ids, texts, held = 0, [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), as_bytes(b, 1), strict=True):
            ids.append(i)
            texts.append(t or b"")
            held += len(texts[-1])
            if held >= chunk_bytes:
                yield base + no, ids, texts
                no, ids, texts, held = no + 1, [], [], 0
    if ids:
        yield base + no, ids, texts


def _pack(words: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress("\n".join(words).encode("utf-8"))


def _unpack(blob: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(blob).decode("utf-8").split("\n")


def chunk_words(docs: DataFrame, path: str, buckets: int, chunk_bytes: int) -> DataFrame:
    """(bucket, chunk, words): the distinct words of each chunk, in sorted packed blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_at(path)
        for chunk, _, texts in _chunks(batches, chunk_bytes):
            seen: set[str] = set()
            for t in texts:
                seen.update(tok.words(t.decode("utf-8", "replace")))
            parts: dict[int, list[str]] = {}
            for w in sorted(seen):
                parts.setdefault(zlib.crc32(w.encode("utf-8")) % buckets, []).append(w)
            if parts:
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(list(parts), pa.int32()), "chunk": pa.array([chunk] * len(parts), pa.int64()),
                    "words": pa.array([_pack(ws) for ws in parts.values()], pa.binary())})
    return docs.mapInArrow(run, "bucket int, chunk long, words binary")


def word_table(blocks: DataFrame, path: str) -> DataFrame:
    """(chunk, words, lengths, ids): each block with the ids of its words, a word encoded once a bucket."""
    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        tok, table, out = tokenizer_at(path), {}, []
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for chunk, blob in zip(pdf["chunk"], pdf["words"], strict=True):
            ids = []
            for w in _unpack(bytes(blob)):
                got = table.get(w)
                if got is None:
                    got = table[w] = tok.ids(w)
                ids.append(got)
            out.append((chunk, bytes(blob), squeeze(np.array([len(x) for x in ids], dtype="<u4").tobytes()),
                        squeeze(np.array([y for x in ids for y in x], dtype="<u4").tobytes())))
        return pd.DataFrame(out, columns=["chunk", "words", "lengths", "ids"])
    return blocks.groupBy("bucket").applyInPandas(encode, "chunk long, words binary, lengths binary, ids binary")


def chunk_texts(docs: DataFrame, id_type: str, chunk_bytes: int) -> DataFrame:
    """(chunk, doc_ids, sizes, texts): the texts of each chunk, packed."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = f"chunk long, doc_ids array<{id_type}>, sizes array<long>, texts binary"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, texts in _chunks(batches, chunk_bytes):
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (chunk, ids, [len(t) for t in texts], blob), schema, strict=True)], schema=schema)
    return docs.mapInArrow(run, ddl)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
                     chunk_bytes: int = 8 << 20, buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (binary, unsigned 32-bit little-endian; null
    without ``with_ids``), ids_sha256, decoded_sha256, decoded_bytes."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()
    answers = word_table(chunk_words(named, path, buckets, chunk_bytes), path)
    texts = chunk_texts(named, id_type, chunk_bytes)
    columns = ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "decoded_bytes"]

    def assemble(packed: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        tok, out = tokenizer_at(path), []
        pieces = tok.pieces()

        class Table(dict):
            def __missing__(self, w):
                self[w] = v = np.array(tok.ids(w), dtype="<u4").tobytes()
                return v

        class Pieces(dict):  # a word's ids joined with the pieces
            def __missing__(self, ids):
                self[ids] = v = " ".join([pieces[i] for i in np.frombuffer(ids, dtype="<u4")])
                return v

        inflate = zstandard.ZstdDecompressor().decompress
        table, decoded = Table(), Pieces()
        for words, lengths, ids in zip(found["words"], found["lengths"], found["ids"], strict=True):
            raw, ends = inflate(bytes(ids)), np.cumsum(np.frombuffer(inflate(bytes(lengths)), dtype="<u4")) * 4
            at = 0
            for w, end in zip(_unpack(bytes(words)), ends.tolist(), strict=True):
                table[w] = raw[at:end]
                at = end
        for ids, sizes, blob in zip(packed["doc_ids"], packed["sizes"], packed["texts"], strict=True):
            joined, at = inflate(bytes(blob)) if len(sizes) and sum(sizes) else b"", 0
            for doc_id, size in zip(ids, sizes, strict=True):
                parts = [table[w] for w in tok.words(joined[at:at + size].decode("utf-8", "replace"))]
                at += size
                raw = b"".join(parts)
                text = " ".join([decoded[p] for p in parts]).encode("utf-8")
                out.append((doc_id, len(raw) // 4, raw if with_ids else None, hashlib.sha256(raw).hexdigest(),
                            hashlib.sha256(text).hexdigest(), len(text)))
        return pd.DataFrame(out, columns=columns)

    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        assemble, f"doc_id {id_type}, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string, decoded_bytes long")


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Decode binary ids: positions are exploded, joined with the id-to-piece table, set back in order."""
    spark = encoded.sparkSession
    tok = WordTokenizer(path)
    pieces = spark.createDataFrame(list(enumerate(tok.pieces())), "id long, piece string")  # one row per id
    rows = encoded.withColumn("_row", F.monotonically_increasing_id())
    n = (F.octet_length(ids_col) / 4).cast("int")
    spread = rows.where(F.octet_length(ids_col) > 0).select(
        "_row", F.hex(ids_col).alias("_hex"), F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    byte = [F.expr(f"substring(_hex, 8 * k + {2 * j + 1}, 2)") for j in (3, 2, 1, 0)]
    spread = spread.select("_row", "k", F.conv(F.concat(*byte), 16, 10).cast("long").alias("id"))
    joined = spread.join(F.broadcast(pieces), "id")
    text = joined.groupBy("_row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "piece"))), lambda x: x["piece"]), " ").alias(out))
    return rows.join(text, "_row", "left").drop("_row").withColumn(out, F.coalesce(F.col(out), F.lit("")))
