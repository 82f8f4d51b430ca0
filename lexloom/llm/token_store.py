"""Token ids as raw binary shards with a minimal perfect hash index (operator 1).

Files, all in one folder that driver and executors share:

``shard-00000.ids``  the ids of consecutive documents, little-endian unsigned, nothing else: 16 bits each
                     if the vocabulary has at most 65,536 entries, else 32 bits.
``meta``             the number of index files and of shards, and the bytes of an id.
``index-00000.mph``  a header, bit levels, then one record a key in the order of the hash:
                     fingerprint u32, shard u32, offset u64 and length u64 (in ids). A level is blocks of 512
                     bits, each after the number of bits set before it in the file.

A key is (doc_id, copy): copy counts the rows with that id, from 0. Keys are dealt to index files
by hash. Inside one, level after level, each key is hashed to a bit of the level; keys alone on
their bit are settled, the others go to the next level. A key's number is the count of set bits
before its own: minimal and perfect, by about 3 bits a key and two hashes. The record's fingerprint
tells foreign keys from known ones (one in 2^32 passes by chance). ``read`` reads the header, a block of
each level it tries (fewer than three as a rule), one record and one slice of a shard, whatever the size of the store.

Shards are written from a range partitioning by doc_id, null first, then by length and hash of the text, so that
shards and the documents in them ascend, and the rows of one doc_id may go to many shards. A task writes to a name of its own and then renames, so a task that is
run again leaves the same files.
"""

from __future__ import annotations

import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir

END = 1
#: Keys of an index file, and words a worker remembers.
INDEX_KEYS, WORDS = 1 << 16, 700_000
RECORD = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])
BLOCK = np.dtype([("before", "<u4"), ("words", "<u8", (8,))])
_MAGIC = b"MPHIDX02"
_NULL = -(1 << 63)


# --- hashing -------------------------------------------------------------------------------------
def mix(keys: np.ndarray, copies: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key under a seed (two rounds of the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
        for extra in (copies.astype(np.uint64) * np.uint64(0xD1342543DE82EF95), np.uint64(seed)):
            z = z + extra
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z = z ^ (z >> np.uint64(31))
    return z


class Index:
    """A minimal perfect hash over distinct keys, with their records."""

    PRINT_SEED = 0xF1

    def __init__(self, sizes: list[int], blocks: list[np.ndarray], records: np.ndarray):
        """sizes: bits of each level; blocks: its bits (BLOCK). All may be views of a file's bytes."""
        self.sizes, self.blocks, self.records = sizes, blocks, records

    @staticmethod
    def block_counts(sizes: list[int]) -> list[int]:
        return [-(-size // 512) for size in sizes]

    @staticmethod
    def bits_before(blocks: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each slot of 512 in its block: whether its bit is set, and the number of bits set before it in the file."""
        words, nth, bit = blocks["words"], slots >> 6, (slots & 63).astype(np.uint64)
        own = np.take_along_axis(words, nth[:, None], 1)[:, 0]
        earlier = (np.bitwise_count(words) * (np.arange(8) < nth[:, None])).sum(1, dtype=np.int64)
        inside = np.bitwise_count(own & ((np.uint64(1) << bit) - np.uint64(1)))
        return (own >> bit & np.uint64(1)).astype(bool), blocks["before"].astype(np.int64) + earlier + inside

    @classmethod
    def build(cls, keys: np.ndarray, copies: np.ndarray, records: np.ndarray) -> Index:
        """Index of records (shard, offset, length) by distinct (key, copy); fingerprints are filled in."""
        sizes, levels, left, number, settled = [], [], np.arange(len(keys)), np.zeros(len(keys), np.int64), 0
        while len(left):
            size = max(64, len(left))
            at = (mix(keys[left], copies[left], len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            blocks = np.zeros(-(-size // 512), BLOCK)
            blocks["words"] = np.packbits(np.pad(alone, (0, 512 * len(blocks) - size)), bitorder="little").view("<u8").reshape(-1, 8)
            ones = np.bitwise_count(blocks["words"]).sum(1, dtype=np.int64)
            blocks["before"] = settled + np.cumsum(ones) - ones
            sizes.append(size)
            levels.append(blocks)
            mine = alone[at]
            number[left[mine]] = settled + np.cumsum(alone)[at[mine]] - 1
            settled += int(alone.sum())
            left = left[~mine]
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
        out = np.zeros(len(keys), RECORD)
        out[number] = records
        out["print"][number] = cls.prints(keys, copies)
        return cls(sizes, levels, out)

    @classmethod
    def prints(cls, keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
        return (mix(keys, copies, cls.PRINT_SEED) >> np.uint64(32)).astype(np.uint32)

    def find(self, keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """The record number of each key, -1 for those that are not in the index."""
        number, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, (size, blocks) in enumerate(zip(self.sizes, self.blocks)):
            if not len(left):
                break
            at = (mix(keys[left], copies[left], k) % np.uint64(size)).astype(np.int64)
            hit, before = self.bits_before(blocks[at >> 9], at & 511)
            number[left[hit]] = before[hit]
            left = left[~hit]
        known = number >= 0
        known[known] = self.records["print"][number[known]] == self.prints(keys[known], copies[known])
        return np.where(known, number, -1)

    def dump(self) -> bytes:
        head = struct.pack("<8sII", _MAGIC, len(self.sizes), len(self.records)) + struct.pack(f"<{len(self.sizes)}Q", *self.sizes)
        return head + b"".join(x.tobytes() for x in self.blocks) + self.records.tobytes()

    @staticmethod
    def head(raw: bytes) -> tuple[int, int]:
        """Levels and records of a file that begins with these 16 bytes."""
        magic, levels, n = struct.unpack_from("<8sII", raw)
        if magic != _MAGIC:
            raise ValueError("not an index file")
        return levels, n

    @classmethod
    def load(cls, raw: bytes) -> Index:
        """The index of a whole file, as views of its bytes."""
        n_levels, n = cls.head(raw)
        sizes, at, blocks = list(struct.unpack_from(f"<{n_levels}Q", raw, 16)), 16 + 8 * n_levels, []
        for count in cls.block_counts(sizes):
            blocks.append(np.frombuffer(raw, BLOCK, count, at))
            at += count * BLOCK.itemsize
        return cls(sizes, blocks, np.frombuffer(raw, RECORD, n, at))

    @classmethod
    def record(cls, read_at, key: int, copy: int) -> np.void | None:
        """The record of one key by parts of the file, given as read_at(bytes, offset); None if the key is not there."""
        n_levels, _ = cls.head(read_at(16, 0))
        sizes = struct.unpack(f"<{n_levels}Q", read_at(8 * n_levels, 16)) if n_levels else ()
        counts, at = cls.block_counts(sizes), 16 + 8 * n_levels
        records, keys, copies = at + BLOCK.itemsize * sum(counts), np.array([key]), np.array([copy])
        for k, (size, count) in enumerate(zip(sizes, counts)):
            slot = int(mix(keys, copies, k)[0] % np.uint64(size))
            block = np.frombuffer(read_at(BLOCK.itemsize, at + BLOCK.itemsize * (slot >> 9)), BLOCK)
            hit, before = cls.bits_before(block, np.array([slot & 511]))
            if hit[0]:
                found = np.frombuffer(read_at(RECORD.itemsize, records + RECORD.itemsize * int(before[0])), RECORD)[0]
                return found if found["print"] == cls.prints(keys, copies)[0] else None
            at += BLOCK.itemsize * count
        return None


# --- encoding ------------------------------------------------------------------------------------
#: Characters that byte-level files write for bytes: printable Latin-1 as it is, the others from U+0100 on.
_AS_IS = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SYMBOLS = string.punctuation.encode()
_BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _AS_IS)}


class WordEncoder:
    """Encodes with a tokenizers file whose normaliser and pattern keep no token across a blank or line feed.

    Lower-casing ASCII, splitting at blanks and line feeds, and splitting ASCII symbols off a letter or
    ASCII digit before them change nothing in the ids of such a file, so unseen words only go through the library.
    A word that is letters only after the library's normaliser is one match of the pattern, and goes to
    the library's BPE model at once; other words go through the whole library, many at a time, and so
    does a text with the opening of a special token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}{self.code}", *e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        """Takes up the ids of words without blanks or line feeds."""
        plain = [w.decode() for w in words]
        normal = self.tokenizer.normalizer.normalize_str(" ".join(plain)).split(" ")
        if len(normal) != len(plain):  # other white space was made a blank
            normal = [""] * len(plain)
        # Python's and the library's letters may differ in recent scripts, which lie above this.
        single = [n.isalpha() and max(n) < "\u2000" for n in normal]
        model, code = self.tokenizer.model, self.code
        for word, n in zip((w for w, s in zip(words, single) if s), (n for n, s in zip(normal, single) if s)):
            found = [t.id for t in model.tokenize(n if n.isascii() else n.encode().decode("latin-1").translate(_BYTE_CHARS))]
            self.known[word] = struct.pack(f"<{len(found)}{code}", *found)
        rest = [k for k, s in enumerate(single) if not s]
        self.known.update(zip((words[k] for k in rest), self._ids([plain[k] for k in rest])))

    @staticmethod
    @lru_cache(4096)
    def _letter(char: str) -> bool:
        """Whether the library's normaliser leaves letters only of a letter below U+2000: no mark that would join what follows."""
        return char < "\u2000" and normalize("NFC", char).lower().isalpha()

    def _halves(self, word: bytes) -> tuple[bytes, bytes] | None:
        """A word's beginning and its ASCII symbols at the end, if a match of the pattern ends between them."""
        stem = word.rstrip(_SYMBOLS)
        if not stem or len(stem) == len(word):
            return None
        last = stem[-1]
        if 97 <= last <= 122 or 48 <= last <= 57 or last > 127 and self._letter(stem.decode()[-1]):
            return stem, word[len(stem) :]
        return None

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``width`` bytes."""
        split: list[list[bytes] | None] = []
        for t in texts:
            raw = (t or "").encode()
            split.append(None if b"<|" in raw else raw.lower().replace(b"\n", b" ").split(b" "))
        if 2 * len(self.known) > WORDS:  # the older half gives back what is met again
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        met: set[bytes] = set()
        met.update(*filter(None, split))
        new, bare, later = [], set(), []
        for w in met.difference(known):
            if (ids := older.get(w)) is not None:
                known[w] = ids
            elif halves := self._halves(w):
                later.append((w, *halves))
                bare.update(halves)
            else:
                bare.add(w)
        for w in bare.difference(known):
            if (ids := older.get(w)) is not None:
                known[w] = ids
            else:
                new.append(w)
        for k in range(0, len(new), 4096):
            self._learn(new[k : k + 4096])
        for w, stem, tail in later:
            known[w] = known[stem] + known[tail]
        return [self._ids([t])[0] if ws is None else b"".join(map(known.__getitem__, ws)) for t, ws in zip(texts, split)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, one a process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids binary) of every row of (doc_id, text): the ids of the whole text, then END; null texts are empty."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        end = struct.pack(f"<{code.code}", END)
        for whole in batches:
            for b in (whole.slice(k, 512) for k in range(0, whole.num_rows, 512)):
                ids = [x + end for x in code.encode(b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, ids binary")


# --- files ---------------------------------------------------------------------------------------
def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _write(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    fs, base = _filesystem(folder)
    draft = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as f:
        for c in chunks:
            f.write(c)
    fs.move(draft, f"{base}/{name}")


def write(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Writes the store of docs (doc_id, text) and returns its entries: doc_id, copy, shard, offset, length.

    An empty table makes a store without entries. Rows that repeat are kept, each as a copy of its doc_id.
    """
    from pyspark import TaskContext

    fs, base = _filesystem(folder)
    fs.create_dir(base, recursive=True)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.asc_nulls_first("doc_id")
    width = encoder(path).width
    # The rows of one doc_id may fall into many ranges; a given number of ranges is not merged again.
    # Texts are dealt out rather than ids: ids are larger, and finding the ranges would encode everything twice.
    within = (order, F.length("text"), F.xxhash64("text"))
    placed = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, *within)
    ranged = encode(placed.sortWithinPartitions(*within), path)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = TaskContext.get().partitionId(), []

        def payload() -> Iterator[bytes]:
            offset, last, copy = 0, object(), 0
            for b in batches:
                for key, ids in zip(b.column(0).to_pylist(), b.column(1)):
                    raw = ids.as_buffer()
                    copy = copy + 1 if key == last else 0
                    last = key
                    rows.append((key, copy, offset, raw.size // width))
                    offset += raw.size // width
                    yield raw

        _write(folder, f"shard-{shard:05d}.ids", payload())
        for k in range(0, len(rows), 1 << 16):
            ids, copies, offsets, lengths = zip(*rows[k : k + (1 << 16)])
            columns = [pa.array(ids, pa.int64()), pa.array(copies, pa.int32()), pa.array([shard] * len(ids), pa.int32()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "shard", "offset", "length"])

    entries = _numbered(cut(ranged.mapInArrow(each, "doc_id long, copy int, shard int, offset long, length long")))
    files = max(1, -(-entries.count() // INDEX_KEYS))
    build_index(entries, folder, files)
    _write(folder, "meta", iter([struct.pack("<III", files, parts, width)]))
    return entries


def _numbered(entries: DataFrame) -> DataFrame:
    """entries with copies counted through all shards that a doc_id goes on in, instead of in each.

    Such a doc_id begins all these shards but the first, so there are fewer of them than shards.
    """
    from pyspark.sql import Window as W

    first = entries.where("offset = 0 and copy = 0").select(F.col("doc_id").alias("key")).distinct()
    here = entries.join(F.broadcast(first), F.col("doc_id").eqNullSafe(F.col("key"))).groupBy("key", F.col("shard").alias("at")).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("key").orderBy("at").rowsBetween(W.unboundedPreceding, -1))
    carry = here.select("key", "at", earlier.alias("carry")).where("carry > 0")  # at most a row a shard
    out = entries.join(F.broadcast(carry), F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("shard") == F.col("at")), "left")
    return out.select("doc_id", (F.col("copy") + F.coalesce("carry", F.lit(0))).cast("int").alias("copy"), "shard", "offset", "length")


def _meta(folder: str) -> tuple[int, int, int]:
    fs, base = _filesystem(folder)
    with fs.open_input_stream(f"{base}/meta") as f:
        return struct.unpack("<III", f.read())


def _wide(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}").astype("<u4", copy=False)


def _bucket(files: int):
    """The index file of a key, as the reader and the writer of an index find it."""
    return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(_NULL)), "copy"), F.lit(files)).cast("int")


def build_index(entries: DataFrame, folder: str, files: int) -> None:
    """Writes the index files of entries, each by the task that its keys are dealt to."""

    def each(key: tuple, got: pa.Table) -> pa.Table:
        keys = got.column("doc_id").fill_null(_NULL).to_numpy()
        records = np.zeros(len(keys), RECORD)
        for name in ("shard", "offset", "length"):
            records[name] = got.column(name).to_numpy()
        index = Index.build(keys, got.column("copy").to_numpy(), records)
        _write(folder, f"index-{key[0].as_py():05d}.mph", iter([index.dump()]))
        return pa.table({"n": pa.array([len(keys)], pa.int64())})

    entries.withColumn("bucket", _bucket(files)).groupBy("bucket").applyInArrow(each, "n long").agg(F.sum("n")).first()


def lookup(keys: DataFrame, folder: str) -> DataFrame:
    """Rows of keys (doc_id, copy) that the store has: doc_id, copy, shard, offset, length, from the index alone."""
    files = _meta(folder)[0]

    def each(key: tuple, got: pa.Table) -> pa.Table:
        fs, base = _filesystem(folder)
        with fs.open_input_stream(f"{base}/index-{key[0].as_py():05d}.mph") as f:
            index = Index.load(f.read())
        at = index.find(got.column("doc_id").fill_null(_NULL).to_numpy(), got.column("copy").to_numpy())
        found = index.records[at[at >= 0]]
        got = got.select(["doc_id", "copy"]).filter(pa.array(at >= 0))
        for name, kind in (("shard", np.int32), ("offset", np.int64), ("length", np.int64)):
            got = got.append_column(name, pa.array(found[name].astype(kind)))
        return got

    return keys.withColumn("bucket", _bucket(files)).groupBy("bucket").applyInArrow(each, "doc_id long, copy int, shard int, offset long, length long")


def fetch(places: DataFrame, folder: str) -> DataFrame:
    """places with ids_crc32 of the slice of the shard that each names; ``read`` gives the ids themselves."""
    width = _meta(folder)[2]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        name, file = None, None
        for b in batches:
            sums = []
            for shard, offset, length in zip(*(b.column(k).to_pylist() for k in ("shard", "offset", "length"))):
                if shard != name:
                    if file:
                        file.close()
                    name, file = shard, fs.open_input_file(f"{base}/shard-{shard:05d}.ids")
                sums.append(zlib.crc32(_wide(file.read_at(width * length, width * offset), width)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums, pa.int64())], names=[*b.schema.names, "ids_crc32"])

    names = "doc_id long, copy int, shard int, offset long, length long, ids_crc32 long"
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return places.repartition(parts, "shard").sortWithinPartitions("shard", "offset").mapInArrow(each, names)


def read(spark: SparkSession, folder: str, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
    """The ids of one document by its key: a few blocks and one record of an index file, one slice of a shard; None if it is not there."""
    fs, base = _filesystem(folder)
    files, _, width = _meta(folder)
    row = spark.createDataFrame([(doc_id, copy)], "doc_id long, copy int").select(_bucket(files)).first()
    path = f"{base}/index-{row[0]:05d}.mph"
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_file(path) as f:
        record = Index.record(f.read_at, _NULL if doc_id is None else doc_id, copy)
    if record is None:
        return None
    with fs.open_input_file(f"{base}/shard-{record['shard']:05d}.ids") as f:
        return _wide(f.read_at(width * int(record["length"]), width * int(record["offset"])), width)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Writes a store of docs and reads every document back by key: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before, in ascending doc_id (null first).
    """
    folder = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    entries = write(docs, path, folder)
    # One row a shard; shards ascend, so a shard starts after all earlier ones.
    from pyspark.sql import Window as W

    totals = entries.groupBy("shard").agg(F.sum("length").alias("ids"))
    starts = totals.select(F.col("shard").alias("s"), F.coalesce(F.sum("ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    # The keys come from the documents, not from what was written.
    counts = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    thousands = counts.select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1000).cast("int"))).alias("k"))
    last = F.least(F.col("n") - 1, F.col("k") * 1000 + 999).cast("int")
    keys = thousands.select("doc_id", F.explode(F.sequence(F.col("k") * 1000, last)).alias("copy"))
    got = fetch(lookup(keys, folder), folder)
    return got.join(F.broadcast(starts), got.shard == starts.s).select("doc_id", (F.col("base") + F.col("offset")).alias("start"), F.col("length").alias("n_tokens"), "ids_crc32")
