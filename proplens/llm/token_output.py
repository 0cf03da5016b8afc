"""Token-id output: flat unsigned integer files with 64-bit document offsets, written by tasks and read memory-mapped.

Documents are dealt by ranges of their identifier, so partition p's file follows that of p - 1.  A task streams its
ids to ``part-p.bin`` and its offsets, from 0, to ``part-p.idx`` (64-bit, one more than documents) and its identifiers
to ``part-p.ids``; files appear under their name only when whole, so a repeated task writes the same once more.  The
counts' prefix sums are the partitions' bases: a document's place in the corpus is base plus offset.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proplens.llm.common import scratch_uri

#: A null identifier in an .ids file.
NO_ID = -(1 << 63)
#: Bytes of pieces with their ids that a task remembers, and of text that it encodes at once.
REMEMBERED_BYTES = 32 << 20
BLOCK_BYTES = 8 << 20
#: One space or line feed between two characters that are not white space: the pre-tokenizer always splits before it.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Pieces that the fast cut may leave: a lone line feed, or characters without white space after at most one space.
_WHOLE = re.compile(r"\n| ?\S+")
#: Stands at cuts; a text that has it is cut by pattern.
_MARK = "\0"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
#: The spelling of characters up to U+024F in that alphabet, for whole words at once; a word of others is spelt by bytes.
_SPELLING = {i: "".join(_LETTERS[b] for b in chr(i).encode()) for i in range(0x250)}


@lru_cache(1)
def tokenizer(path: str):
    """Loaded once a process, some 40 MB: reading the file for every task would take a tenth of its time."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PieceEncoder:
    """Encodes texts with the tokenizers library, each distinct piece about once.

    The byte-level pre-tokenizer lets a single space only begin a token and never joins one to what stands before it, so
    a text gives the same ids whole or cut before such a space; a lone line feed is a token by itself, and one ends
    between a letter and a punctuation mark.  A piece of letters is one pre-token, for which the library's model is
    asked directly; any other is encoded as a text.  Texts with other white space than lone spaces and line feeds are
    cut by pattern instead, and one with the string of an added token is encoded whole: the library, at its default,
    gives that string the added token's id.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, list[int]] = {}
        self.room = REMEMBERED_BYTES

    def _piece(self, piece: str, checked: bool = False) -> list[int] | None:
        """Ids of a piece, or None if the fast cut may not leave it so and it isn't ``checked``."""
        bare = piece[1:] if piece[0] == " " else piece
        if not bare.isalpha():
            if not checked and not _WHOLE.fullmatch(piece):
                return None
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        else:
            if piece.isascii():
                letters = piece if bare is piece else _LETTERS[0x20] + bare
            elif max(piece) < "\u0250":
                letters = piece.translate(_SPELLING)
            else:
                letters = "".join(map(_LETTERS.__getitem__, piece.encode()))
            ids = [t.id for t in self.tokenizer.model.tokenize(letters)]
        return ids

    def _remember(self, piece: str, ids: list[int]) -> None:
        self.room -= 250 + 4 * len(piece) + 8 * len(ids)  # the entry's objects, a string and a list of shared numbers
        if self.room < 0:
            self.known.clear()
            self.room = REMEMBERED_BYTES
        self.known[piece] = ids

    def whole(self, text: str) -> list[int]:
        """Ids of any text."""
        if any(a in text for a in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        out: list[int] = []
        for p in _CUT.split(text) if text else []:
            for part in ("\n", p[1:]) if p[0] == "\n" and p[1:2].strip() else (p,):
                out += self.known.get(part) or self._piece(part, True)
        return out

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        marked = pc.replace_substring(pc.replace_substring(texts, " ", _MARK + " "), "\n", f"{_MARK}\n{_MARK}")
        split = pc.split_pattern(pc.replace_substring_regex(marked, "([a-z])([.,!?;:])", rf"\1{_MARK}\2"), _MARK)
        pieces = pc.dictionary_encode(pc.list_flatten(split))
        names, code = pieces.dictionary.to_pylist(), pieces.indices.to_numpy()
        first = split.offsets.to_numpy().astype(np.int64)
        first = first - first[0]
        known, piece = self.known.get, self._piece
        ids = [known(n) or (piece(n) if n else None) for n in names]
        odd = np.fromiter((x is None for x in ids), bool, len(ids))
        for i in np.flatnonzero(np.bincount(code, minlength=len(names)) > 1):  # what comes once here seldom comes again
            if ids[i] and names[i] not in self.known:
                self._remember(names[i], ids[i])
        bad = np.r_[0, np.cumsum(odd[code])]
        whole = np.logical_or.reduce([pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
                                      for a in (_MARK, *self.added)])
        slow = np.flatnonzero((bad[first[1:]] > bad[first[:-1]]) | whole)
        size = np.fromiter((len(x) if x else 0 for x in ids), np.int32, len(ids))
        flat = np.fromiter(chain.from_iterable(x for x in ids if x), self.kind, int(size.sum()))
        begin = (np.cumsum(size, dtype=np.int64) - size)
        n = size[code]
        ends = np.r_[0, np.cumsum(n, dtype=np.int64)]
        tokens = flat[np.repeat(begin[code] - ends[:-1], n) + np.arange(ends[-1])]
        counts = ends[first[1:]] - ends[first[:-1]]
        if len(slow):
            parts = np.split(tokens, np.cumsum(counts)[:-1])
            for i in slow:
                parts[i] = np.array(self.whole(texts[int(i)].as_py()), self.kind)
            tokens, counts = np.concatenate(parts), np.array([len(x) for x in parts])
        return tokens, counts


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of the shared folder: any that pyarrow reaches by URI; s3a: and s3n: are its s3:."""
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    return pyarrow.fs.FileSystem.from_uri(uri if ":" in uri else f"file://{os.path.abspath(uri)}")


def _publish(fs: pyarrow.fs.FileSystem, path: str, attempt: int, data: bytes) -> None:
    with fs.open_output_stream(f"{path}.{attempt}.tmp") as f:
        f.write(data)
    fs.move(f"{path}.{attempt}.tmp", path)


def write_tokens(docs: DataFrame, uri: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> dict:
    """Writes the files below ``uri`` in ascending identifier order and returns the manifest, also put there as JSON.

    Null and empty texts are the end id alone.  Null identifiers come last; rows with equal identifiers stand in the
    order of their text's hash.  Identifiers are whole numbers.  An empty table gives a manifest without parts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        fs, path = _store(uri)
        enc, attempt = PieceEncoder(tokenizer_path), TaskContext.get().taskAttemptId()
        name = f"{path}/part-{TaskContext.get().partitionId():06d}"
        ids, sizes = [], []
        gc.disable()  # a task makes hundreds of thousands of lists and no cycles
        with fs.open_output_stream(f"{name}.bin.{attempt}.tmp") as out:
            for b in batches:
                ids += b["doc_id"].fill_null(NO_ID).to_pylist()
                begin = size = 0
                lengths = np.cumsum(pc.binary_length(b["text"]).to_numpy(), dtype=np.int64)
                while begin < b.num_rows:
                    stop = max(begin + 1, int(np.searchsorted(lengths, size + BLOCK_BYTES, side="right")))
                    tokens, counts = enc.texts(b["text"].slice(begin, stop - begin))
                    out.write(np.insert(tokens, np.cumsum(counts), end_id).tobytes())
                    sizes += (counts + 1).tolist()
                    begin, size = stop, int(lengths[stop - 1])
        kind = enc.kind
        gc.enable()
        del enc  # what it remembers ends with the task: Spark uses this process for others
        pa.default_memory_pool().release_unused()
        if not ids:
            fs.delete_file(f"{name}.bin.{attempt}.tmp")
            return
        fs.move(f"{name}.bin.{attempt}.tmp", f"{name}.bin")
        _publish(fs, f"{name}.idx", attempt, np.cumsum([0, *sizes], dtype="<u8").tobytes())
        _publish(fs, f"{name}.ids", attempt, np.array(ids, "<i8").tobytes())
        yield pa.RecordBatch.from_pylist([{"part": name.rsplit("/", 1)[1], "docs": len(ids), "tokens": int(sum(sizes)),
                                           "dtype": kind.str}])

    fs, path = _store(uri)
    fs.create_dir(path)
    parts = sorted(rows.mapInArrow(run, "part string, docs long, tokens long, dtype string").collect())  # one a partition
    bases = np.cumsum([0, *(p["tokens"] for p in parts)])
    manifest = {"end_id": end_id, "dtype": parts[0]["dtype"] if parts else "<u2", "tokens": int(bases[-1]),
                "parts": [{"part": p["part"], "docs": p["docs"], "tokens": p["tokens"], "base": int(b)}
                          for p, b in zip(parts, bases)]}
    _publish(fs, f"{path}/manifest.json", 0, json.dumps(manifest).encode())
    return manifest


def _mapped(uri: str, name: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped on a local or mounted folder, read through its file system elsewhere."""
    fs, path = _store(uri)
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", kind, "r")
    with fs.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), kind)


def read_tokens(spark: SparkSession, uri: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (of ids as little-endian 32-bit)."""
    fs, path = _store(uri)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        manifest = json.loads(f.read())
    kind = manifest["dtype"]

    def run(batches):
        for b in batches:
            for part, base in zip(b["part"].to_pylist(), b["base"].to_pylist()):
                at = _mapped(uri, f"{part}.idx", "<u8").astype(np.int64)
                ids, tokens = _mapped(uri, f"{part}.ids", "<i8"), _mapped(uri, f"{part}.bin", kind)
                for i in range(0, len(ids), 20_000):
                    crc = [zlib.crc32(tokens[a:z].astype("<u4").tobytes())
                           for a, z in zip(at[i:i + 20_000], at[i + 1:i + 20_001])]
                    own = np.array(ids[i:i + 20_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, mask=own == NO_ID), pa.array(at[i:i + len(own)] + base),
                         pa.array(np.diff(at[i:i + len(own) + 1])), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = manifest["parts"]
    frame = spark.createDataFrame([(p["part"], p["base"]) for p in parts], "part string, base long")
    return frame.repartition(max(1, len(parts))).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", uri: str | None = None) -> DataFrame:
    """``write_tokens`` to ``uri`` (by default a new path in the shared folder), then ``read_tokens`` from there."""
    uri = uri or scratch_uri(docs.sparkSession, "tokens")
    write_tokens(docs, uri, tokenizer_path, end_id, id_col, text_col)
    return read_tokens(docs.sparkSession, uri)
