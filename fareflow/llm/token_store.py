"""Token ids of documents in files of independently coded, checksummed blocks.

A row of the file is a segment: whole documents in order, their lengths, and the codes and checksums
of the blocks that their ids are cut into. Rows of one file part follow each other, and parts hold
ascending ranges of ids. Any segment, and within it any block, can be read alone.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fareflow.llm import range_coder
from fareflow.llm.columns import only
from fareflow.llm.words import row_slices
from fareflow.operators.joins import small_side
from fareflow.session import fresh_path

END_ID = 1
_END = np.array([END_ID], "<u2").tobytes()
#: Ids in a segment, unless one document has more.
SEGMENT_IDS = 1 << 16
#: Ids that a worker codes at once.
HELD_IDS = 8 << 20
#: Words whose ids a worker remembers; beyond, it starts to remember anew.
MEMORY = 1 << 20
#: Bytes of text encoded at once.
SLICE = 8 << 20

# What lets words be parted without the library: its steps before the pairs are merged, and words that they treat as ``_PIECE`` does.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+|\n").findall

_tokenizers: dict[int, WordTokenizer] = {}


class WordTokenizer:
    """Encodes each distinct stretch without ASCII white space once.

    That gives the ids of the whole text for tokenizers that drop white space and never join what it parts.
    If the tokenizer also lower-cases, parts letters, digits and other characters and marks the end of each such piece,
    words of ASCII and common Latin letters are parted here, and the library encodes each distinct piece once.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer, self.pieces, self.known, self.stored = Tokenizer.from_str(definition), None, {}, {}
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        parts = json.loads(definition)
        if parts["normalizer"] == _NORMALIZER and parts["pre_tokenizer"] == _PRE_TOKENIZER and parts["model"].get("end_of_word_suffix") == "</w>":
            split = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, _PRE_TOKENIZER["pretokenizers"][1]]}
            self.pieces = Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "pre_tokenizer": split, "added_tokens": []}))
            self.last = np.zeros(1 << 16, bool)
            self.last[[i for token, i in self.pieces.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids with ``END_ID`` behind each text, and how many each text has."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words, ends = split.flatten().dictionary_encode(), np.cumsum(split.value_lengths().to_numpy())
        distinct = _strings(words.dictionary)
        self._learn(distinct)
        flat, to = _spread([*map(self.known.__getitem__, distinct), _END], np.insert(words.indices.to_numpy(), ends, len(distinct)))
        return flat, np.diff(to.take(ends + np.arange(len(ends))), prepend=0)

    def _learn(self, words: list[str]) -> None:
        known = self.known
        fresh = [w for w in words if w not in known]
        if len(known) + len(fresh) > MEMORY:
            self.known = known = {w: known[w] for w in words if w in known}
        if self.pieces:
            plain = [_PLAIN(w) is not None and "<|" not in w for w in fresh]
            whole = [w for w, p in zip(fresh, plain) if not p]
            self._part([w for w, p in zip(fresh, plain) if p])
        else:
            whole = fresh
        for k in range(0, len(whole), 1 << 14):
            some = whole[k:k + (1 << 14)]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                known[w] = np.array(e.ids, "<u2").tobytes()

    def _part(self, words: list[str]) -> None:
        """Learn words from their pieces."""
        pieces = pa.array(_PIECE("\n".join([*words, ""]).lower())).dictionary_encode()
        distinct, stored = _strings(pieces.dictionary), self.stored
        if len(stored) > MEMORY:
            stored.clear()
        stored["\n"] = b""
        fresh = [p for p in distinct if p not in stored]
        for k in range(0, len(fresh), 1 << 10):
            some = fresh[k:k + (1 << 10)]
            ids = np.array(self.pieces.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u2")
            ends = (2 * self.last[ids].nonzero()[0] + 2).tolist()
            raw = ids.tobytes()
            stored.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends)], strict=True))
        at = pieces.indices.to_numpy()
        flat, to = _spread([*map(stored.__getitem__, distinct)], at)
        raw = flat.tobytes()
        ends = (2 * to[at == distinct.index("\n")]).tolist() if words else []
        self.known.update(zip(words, [raw[a:b] for a, b in zip([0, *ends], ends)], strict=True))


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _spread(parts: list[bytes], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``parts`` in that order, and where each ends."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 1
    size, first = sizes.take(order), (np.cumsum(sizes) - sizes).take(order)
    to = np.cumsum(size)
    at = np.repeat(first - to + size, size)
    at += np.arange(len(at))
    return np.frombuffer(b"".join(parts), "<u2").take(at), to


def _schema(kind: str) -> str:
    return (f"part int, first long, doc_ids array<{kind}>, lengths array<long>, sizes array<long>, "
            "payloads array<binary>, checksums array<long>")


def write(docs: DataFrame, tokenizer_file: str, path: str) -> None:
    """Write the ids of all texts, each with ``END_ID`` behind it, in ascending order of doc_id.

    Null and empty texts have the end id only. Null doc_ids come first; equal ones are in order of
    a hash of their text. An empty table gives files without rows.
    """
    spark, rows = docs.sparkSession, only(docs, "doc_id", "text")
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    kind = rows.schema["doc_id"].dataType

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = id(definition)
        if key not in _tokenizers:
            _tokenizers.clear()
            _tokenizers[key] = WordTokenizer(definition.value)
        tokenizer, part, first = _tokenizers[key], TaskContext.get().partitionId(), 0
        segments: list[tuple[list, list[np.ndarray]]] = []
        held = open_ = 0

        def coded() -> pa.RecordBatch:
            nonlocal first
            blocks, out = [], {c: [] for c in ("part", "first", "doc_ids", "lengths", "sizes", "payloads", "checksums")}
            cuts = []
            for _, ids in segments:
                flat = np.concatenate(ids)
                own = [flat[i:i + range_coder.BLOCK_IDS] for i in range(0, len(flat), range_coder.BLOCK_IDS)]
                cuts.append((len(blocks), len(blocks) + len(own)))
                blocks += own
            codes = range_coder.encode(blocks)
            for (names, ids), (a, b) in zip(segments, cuts):
                out["part"].append(part)
                out["first"].append(first)
                out["doc_ids"].append(names)
                out["lengths"].append([len(x) for x in ids])
                out["sizes"].append([len(x) for x in blocks[a:b]])
                out["payloads"].append(codes[a:b])
                out["checksums"].append([zlib.crc32(x.astype("<u4").tobytes()) for x in blocks[a:b]])
                first += sum(len(x) for x in ids)
            types = (pa.int32(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for a, b in row_slices(batch.column("text"), SLICE):
                flat, lengths = tokenizer.encode(batch.column("text").slice(a, b - a))
                for name, ids in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), np.split(flat, np.cumsum(lengths)[:-1])):
                    if not segments or open_ + len(ids) > SEGMENT_IDS:
                        if held >= HELD_IDS:
                            yield coded()
                            segments, held = [], 0
                        segments.append(([], []))
                        open_ = 0
                    segments[-1][0].append(name)
                    segments[-1][1].append(ids)
                    open_ += len(ids)
                    held += len(ids)
        if segments:
            yield coded()

    order = ["doc_id", "_text", "_row"]
    ordered = (rows.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
               .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    ordered.mapInArrow(code, _schema(kind.simpleString())).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = 128  # segments, of about 8 million ids
        for a in range(0, len(batch), step):
            rows = batch.slice(a, step).to_pylist()
            payloads = [p for r in rows for p in r["payloads"]]
            sizes = [n for r in rows for n in r["sizes"]]
            blocks = range_coder.decode(payloads, sizes)
            for ids, check in zip(blocks, (c for r in rows for c in r["checksums"])):
                if zlib.crc32(ids.astype("<u4").tobytes()) != check:
                    raise ValueError("a block does not match its checksum")
            names, parts, starts, ids_of, at = [], [], [], [], 0
            for r in rows:
                flat = np.concatenate(blocks[at:at + len(r["sizes"])])
                at += len(r["sizes"])
                ends = np.cumsum(r["lengths"])
                names += r["doc_ids"]
                parts += [r["part"]] * len(ends)
                starts += (r["first"] + ends - r["lengths"]).tolist()
                ids_of += np.split(flat.astype("<u4"), ends[:-1])
            flat = np.concatenate(ids_of)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids_of])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, batch.schema.field("doc_ids").type.value_type), pa.array(parts, pa.int32()), pa.array(starts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))],
                ["doc_id", "part", "first", "ids"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of the documents in the files; a damaged block raises an error."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    return files.mapInArrow(_decoded, f"doc_id {kind}, part int, first long, ids array<int>").join(
        _offsets(files), "part").select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "ids")


def _offsets(files: DataFrame) -> DataFrame:
    """Ids before each file part: one row for each part."""
    totals = files.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return small_side(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _decoded(batches):
        ids = batch.column("ids")
        values, ends = np.asarray(ids.values).astype("<u4"), np.asarray(ids.offsets)
        raw, cuts = memoryview(values.tobytes()), (4 * ends).tolist()
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("doc_id", "part", "first")], pa.array(np.diff(ends).astype(np.int64)),
             pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())],
            ["doc_id", "part", "first", "n_tokens", "ids_crc32"])


def report(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row, from files written for it in the shared folder."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "token-ids")
    write(docs, tokenizer_file, path)
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    return files.mapInArrow(_summed, f"doc_id {kind}, part int, first long, n_tokens long, ids_crc32 long").join(
        _offsets(files), "part").select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
