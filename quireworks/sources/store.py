"""The collection store: Parquet tables under one root.

``collections``  uuid=.../ with name, cmetadata
``embeddings``   collection_id=.../generation=.../batch_id=.../ with uuid, document,
                 cmetadata, custom_id, content_hash, embedding, and the keys of finished
                 work that the batch stands for in a hidden folder ``_keys``
``hashes``       collection_id=.../generation=.../buckets=.../batch_id=.../ with hash:
                 32 bytes, in buckets (small batches beside many others in one, a file of
                 that name without a folder)

A collection is a partition, so a search or a hash lookup in one reads no other. A batch
is written and checked aside and published by renaming its folder, rows and keys at
once; written again it replaces itself. Compaction writes a whole generation aside and
publishes it by one rename: the highest generation counts, and batches that came into the
one before meanwhile are moved over. The folder of hashes only makes lookups cheap: the
hashes of a batch that has none there are taken from its rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quireworks.operators.dedupe import BROADCAST_HASHES
from quireworks.session import beside, delete_path, folder_bytes, list_names, move_path, path_exists

COLLECTIONS_SCHEMA = "name string, cmetadata string, uuid string"
ROW_COLUMNS = ("uuid", "document", "cmetadata", "custom_id", "content_hash", "embedding")
_ROW_FIELDS = (
    "uuid string, document string, cmetadata string, custom_id string, content_hash string, "
    "embedding array<float>"
)
ROWS_SCHEMA = f"{_ROW_FIELDS}, collection_id string, batch_id string"
KEYS_SCHEMA = "kind string, key string"
# Files that the hashes of a batch are spread over: about one for 50 million hashes of a
# collection is enough, as a task of a lookup holds one bucket of the batch it looks up.
HASH_BUCKETS = 16
# Bytes of a compacted file, about: what one task sorts and writes.
FILE_BYTES = 256 << 20
# Where a collection has as many batches in buckets as there are buckets, a batch of fewer
# hashes has all of them in one file: thousands of small batches, each in as many files as
# there are buckets, would take long to open.
SMALL_BATCH = 100_000


class CollectionStore:
    def __init__(self, spark: SparkSession, root: str, hash_buckets: int = HASH_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.hash_buckets = hash_buckets

    @property
    def _collections(self) -> str:
        return f"{self.root}/collections"

    @property
    def _embeddings(self) -> str:
        return f"{self.root}/embeddings"

    def _aside(self) -> str:
        """A folder for what isn't published yet."""
        return f"{self.root}/aside/{uuid.uuid4().hex}"

    @staticmethod
    def collection_id(name: str) -> str:
        """Key of a collection, made from its name."""
        return hashlib.sha256(name.encode()).hexdigest()

    # Collections

    def collections(self) -> DataFrame:
        if not path_exists(self.spark, self._collections):
            return self.spark.createDataFrame([], COLLECTIONS_SCHEMA)
        return self.spark.read.schema(COLLECTIONS_SCHEMA).parquet(self._collections)

    def create_collection(self, name: str, dimension: int | None = None) -> str:
        """Id of the collection; adds it where it is missing. Writers that create the same
        one at the same time write the same row to the same place. ``dimension`` is the
        length of its vectors; a collection without gets it with its first batch."""
        key = self.collection_id(name)
        path = f"{self._collections}/uuid={key}"
        if not path_exists(self.spark, path) or (dimension is not None and self.dimension(name) is None):
            metadata = None if dimension is None else json.dumps({"dimension": dimension})
            row = self.spark.createDataFrame([(name, metadata)], "name string, cmetadata string")
            row.coalesce(1).write.mode("overwrite").parquet(path)
        return key

    def dimension(self, name: str) -> int | None:
        """Length of a collection's vectors, null while it has none."""
        path = f"{self._collections}/uuid={self.collection_id(name)}"
        if not path_exists(self.spark, path):
            return None
        row = self.spark.read.schema("cmetadata string").parquet(path).first()
        return json.loads(row.cmetadata or "{}").get("dimension") if row else None

    def drop_collection(self, name: str) -> None:
        """Remove a collection and all of its rows, the rows last."""
        key = self.collection_id(name)
        delete_path(self.spark, f"{self._collections}/uuid={key}")
        delete_path(self.spark, f"{self.root}/hashes/collection_id={key}")
        delete_path(self.spark, f"{self._embeddings}/collection_id={key}")

    # Generations and batches

    def _generations(self, key: str) -> list[int]:
        names = list_names(self.spark, f"{self._embeddings}/collection_id={key}")
        return sorted(int(n.removeprefix("generation=")) for n in names if n.startswith("generation="))

    def _folder(self, key: str, generation: int, table: str = "embeddings") -> str:
        return f"{self.root}/{table}/collection_id={key}/generation={generation}"

    def _batches(self, folder: str) -> set[str]:
        names = list_names(self.spark, folder)
        return {n.removeprefix("batch_id=") for n in names if n.startswith("batch_id=")}

    def _copied(self, folder: str) -> set[str]:
        """Batches that the compaction of a generation has taken in."""
        path = f"{folder}/_copied"
        if not path_exists(self.spark, path):
            return set()
        return {r.key for r in self.spark.read.schema(KEYS_SCHEMA).parquet(path).collect()}

    def _current(self, key: str) -> tuple[int, str]:
        """The generation that counts and its folder.

        A batch that was published into an older one while that was copied is moved over
        first, whoever comes by.
        """
        generations = self._generations(key)
        if not generations:
            return 0, self._folder(key, 0)
        *older, newest = generations
        folder = self._folder(key, newest)
        for generation in older:
            old = self._folder(key, generation)
            if not path_exists(self.spark, f"{old}/_settled"):
                for batch in self._batches(old) - self._copied(folder):
                    move_path(self.spark, f"{old}/batch_id={batch}", f"{folder}/batch_id={batch}")
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{old}/_settled")
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()
        return newest, folder

    def rows(self, name: str | None = None) -> DataFrame:
        """Stored rows, of one collection if a name is given: no other one is listed."""
        if name is None:
            keys = [n.removeprefix("collection_id=") for n in list_names(self.spark, self._embeddings)]
        else:
            keys = [self.collection_id(name)]
        folders = [folder for _, folder in map(self._current, keys) if path_exists(self.spark, folder)]
        if not folders:
            return self.spark.createDataFrame([], ROWS_SCHEMA)
        schema = f"{_ROW_FIELDS}, collection_id string, generation string, batch_id string"
        reader = self.spark.read.schema(schema).option("basePath", self._embeddings)
        return reader.parquet(*folders).drop("generation")

    def count(self, name: str) -> int:
        return self.rows(name).count()

    def batch_rows(self, name: str, batch_id: str) -> DataFrame:
        path = f"{self._current(self.collection_id(name))[1]}/batch_id={batch_id}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _ROW_FIELDS)
        return self.spark.read.schema(_ROW_FIELDS).parquet(path)

    def batch_count(self, name: str, batch_id: str) -> int:
        return self.batch_rows(name, batch_id).count()

    def append(self, rows: DataFrame, name: str, batch_id: str, keys: DataFrame | None = None) -> int:
        """Add one batch, and with it the ``keys`` (kind, key) of the work that it finishes;
        the number of its rows.

        The batch is written aside and checked, and appears by one rename. All vectors of a
        collection have one length, kept in its metadata: a batch of another is refused, and
        nothing has changed. The same batch id written again replaces its own rows only; one
        that a compaction has taken in stays as it is. A batch without rows and keys leaves
        nothing, not even a new collection.
        """
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"batch id {batch_id!r}: letters, digits and . _ - only")
        aside = self._aside()
        try:
            # Observed in the tasks that write, of which each counts once however often it is tried.
            observed, length = Observation(), "CASE WHEN size(embedding) >= 0 THEN size(embedding) END"
            rows.select(*ROW_COLUMNS).sortWithinPartitions("uuid").observe(
                observed, F.expr("count(*) AS n"), F.expr("count(content_hash) AS hashes"),
                F.expr(f"min({length}) AS least"), F.expr(f"max({length}) AS most"),
            ).write.option("parquet.bloom.filter.enabled#uuid", "true").parquet(aside)
            about = observed.get
            buckets = self._buckets(name, about["hashes"])
            written = self.spark.read.schema(_ROW_FIELDS).parquet(aside)

            def write_hashes() -> None:
                if about["hashes"] > SMALL_BATCH:
                    self._write_hashes(written, f"{aside}-hashes")
                else:
                    self._write_few(written, f"{aside}-hashes", buckets)

            with beside(write_hashes if about["hashes"] else None):
                known = self.dimension(name)
                if len({about["least"], about["most"], known} - {None}) > 1:
                    raise ValueError(f"vectors of lengths {about['least']} to {about['most']}, the collection has {known}")
                if keys is not None:
                    keys.select("kind", "key").distinct().write.parquet(f"{aside}/_keys")
                empty = not about["n"] and (keys is None or self.spark.read.schema(KEYS_SCHEMA).parquet(f"{aside}/_keys").isEmpty())
            key = self.collection_id(name)
            if not empty and (known is None or not path_exists(self.spark, f"{self._collections}/uuid={key}")):
                self.create_collection(name, about["most"])
            published = self._publish(key, batch_id, aside, empty, buckets)
            return about["n"] if published else self.batch_count(name, batch_id)
        finally:
            delete_path(self.spark, aside)
            delete_path(self.spark, f"{aside}-hashes")

    def _publish(self, key: str, batch_id: str, aside: str, empty: bool, buckets: int) -> bool:
        """False where a compaction has taken the batch in."""
        generation, folder = self._current(key)
        if batch_id in self._copied(folder):
            return False
        while True:
            target = f"{folder}/batch_id={batch_id}"
            # Without a folder of hashes they are read from the rows, before and after.
            for each in {1, self.hash_buckets}:
                delete_path(self.spark, f"{self._hash_folder(key, generation, each)}/batch_id={batch_id}")
            old = self._aside()
            move_path(self.spark, target, old)
            done = empty or move_path(self.spark, aside, target)
            delete_path(self.spark, old)
            if not done:
                raise RuntimeError(f"batch {batch_id} is being written by another writer")
            # A compaction may have been published meanwhile: its generation gets the batch.
            now, folder = self._current(key)
            if now == generation:
                break
            generation = now
            if path_exists(self.spark, f"{folder}/batch_id={batch_id}") or batch_id in self._copied(folder):
                return False
            move_path(self.spark, target, aside)
        hashes, files = f"{aside}-hashes", list_names(self.spark, f"{aside}-hashes")
        if buckets == 1 and len(files) == 1:
            # Without a folder for each of many batches they are listed in one call.
            hashes = f"{hashes}/{files[0]}"
        move_path(self.spark, hashes, f"{self._hash_folder(key, generation, buckets)}/batch_id={batch_id}")
        return True

    def compact(self, name: str, files: int, file_bytes: int = FILE_BYTES) -> None:
        """Write a collection's rows anew, in ``files`` files by ranges of their keys, or in as
        many more as keep each at about ``file_bytes``, since one task sorts and writes a file.

        The copy is a generation of its own and counts from the rename that publishes it;
        a compaction that breaks off before changes nothing. Batches published meanwhile
        are kept. The generation before stays for readers that have begun, until the next
        compaction.
        """
        key = self.collection_id(name)
        generation, folder = self._current(key)
        batches = self._batches(folder)
        if not batches:
            return
        aside, copy = self._aside(), f"compacted-{generation + 1}"
        taken = self._copied(folder) | batches
        paths = [f"{folder}/batch_id={b}" for b in sorted(batches)]
        try:
            rows = self.spark.read.schema(_ROW_FIELDS).parquet(*paths)
            files = max(files, -(-sum(folder_bytes(self.spark, p) for p in paths) // file_bytes))
            rows.repartitionByRange(files, "uuid").sortWithinPartitions("uuid").write.option(
                "parquet.bloom.filter.enabled#uuid", "true"
            ).parquet(f"{aside}/batch_id={copy}")
            keys = [f"{p}/_keys" for p in paths if path_exists(self.spark, f"{p}/_keys")]
            if keys:
                all_keys = self.spark.read.schema(KEYS_SCHEMA).parquet(*keys).distinct()
                all_keys.write.parquet(f"{aside}/batch_id={copy}/_keys")
            named = self.spark.createDataFrame([("batch", b) for b in sorted(taken)], KEYS_SCHEMA)
            named.coalesce(1).write.parquet(f"{aside}/_copied")
            written = self.spark.read.schema(_ROW_FIELDS).parquet(f"{aside}/batch_id={copy}")
            self._write_hashes(written.filter("content_hash IS NOT NULL"), f"{aside}-hashes")
            if not move_path(self.spark, aside, self._folder(key, generation + 1)):
                raise RuntimeError("another compaction has been published")
            move_path(self.spark, f"{aside}-hashes", f"{self._hash_folder(key, generation + 1)}/batch_id={copy}")
        finally:
            delete_path(self.spark, aside)
            delete_path(self.spark, f"{aside}-hashes")
        self._current(key)
        for old in self._generations(key):
            if old < generation:
                delete_path(self.spark, self._folder(key, old))
                delete_path(self.spark, self._folder(key, old, "hashes"))

    # Keys of finished work

    def keys(self, name: str, kind: str) -> DataFrame:
        """The ``key``s of one kind that a collection's batches were published with."""
        folder = self._current(self.collection_id(name))[1]
        if not any(path_exists(self.spark, f"{folder}/batch_id={b}/_keys") for b in self._batches(folder)):
            return self.spark.createDataFrame([], "key string")
        found = self.spark.read.schema(KEYS_SCHEMA).parquet(f"{folder}/batch_id=*/_keys")
        return found.filter(F.col("kind") == kind).select("key").distinct()

    # Hashes

    def _hash_folder(self, key: str, generation: int, buckets: int | None = None) -> str:
        return f"{self._folder(key, generation, 'hashes')}/buckets={buckets or self.hash_buckets}"

    def _buckets(self, name: str, n_hashes: int) -> int:
        key = self.collection_id(name)
        many = len(self._batches(self._hash_folder(key, self._current(key)[0]))) >= self.hash_buckets
        return 1 if many and n_hashes <= SMALL_BATCH else self.hash_buckets

    def _write_hashes(self, rows: DataFrame, path: str) -> None:
        """The hashes of written rows as a bucketed table; only its files are kept."""
        self._save_buckets(_binary_hashes(rows).repartition(self.hash_buckets, "hash"), path)

    def _write_few(self, rows: DataFrame, path: str, buckets: int) -> None:
        """The hashes of a small batch, by one task: in buckets, or in one file."""
        hashes = _binary_hashes(rows).coalesce(1)
        if buckets == self.hash_buckets:
            self._save_buckets(hashes, path)
        else:
            hashes.write.parquet(path)

    def _save_buckets(self, hashes: DataFrame, path: str) -> None:
        name = f"quireworks_{uuid.uuid4().hex}"
        hashes.write.bucketBy(self.hash_buckets, "hash").sortBy("hash").option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def hashes(self, name: str, without_batch: str | None = None) -> DataFrame:
        """Content hashes of a collection; ``without_batch`` leaves out a batch that is
        being written again."""
        rows = self.rows(name)
        if without_batch is not None:
            rows = rows.filter(F.col("batch_id") != without_batch)
        return rows.filter(F.col("content_hash").isNotNull()).select("content_hash")

    @contextmanager
    def known_hashes(
        self, chunks: DataFrame, name: str, without_batch: str | None = None, n_chunks: int | None = None
    ) -> Iterator[DataFrame]:
        """The ``content_hash``es of a batch that the collection holds, to be read within the
        context: each once, or, of a batch that is broadcast, once for each batch that holds it.

        The stored hashes of large batches are read by buckets and never shuffled: the batch's
        are brought to the same buckets, and a task holds those of one. A batch of at most
        ``BROADCAST_HASHES`` rows (``n_chunks``, where they are counted) is broadcast to all
        stored hashes instead. ``without_batch`` leaves out a batch that is being written again.
        """
        key = self.collection_id(name)
        generation, folder = self._current(key)
        batches = self._batches(folder) - {without_batch}
        path, small = (self._hash_folder(key, generation, n) for n in (self.hash_buckets, 1))
        indexed = self._batches(path) if path != small else set()
        singles = self._batches(small)
        asked = chunks.select(F.unhex("content_hash").alias("hash"))
        few = n_chunks is not None and n_chunks <= BROADCAST_HASHES
        if n_chunks is not None and n_chunks <= SMALL_BATCH:
            asked = asked.coalesce(1)
        asked = F.broadcast(asked) if few else asked.distinct()
        table = f"quireworks_{uuid.uuid4().hex}"
        found, plain = [], []
        if indexed & batches and few:
            plain += _paths(path, indexed, batches)
        elif indexed & batches:
            self.spark.sql(
                f"CREATE TABLE {table} (hash BINARY, batch_id STRING) USING parquet PARTITIONED BY (batch_id) "
                f"CLUSTERED BY (hash) SORTED BY (hash) INTO {self.hash_buckets} BUCKETS LOCATION '{path}'"
            )
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
            stored = self.spark.table(table)
            if others := sorted(indexed - batches):
                stored = stored.filter(~F.col("batch_id").isin(others))
            by_bucket = asked.repartition(self.hash_buckets, "hash").hint("shuffle_hash")
            found.append((stored.select("hash"), by_bucket))
        if singles & batches:
            plain += _paths(small, singles, batches)
        if plain:
            reader = self.spark.read.schema("hash binary").option("recursiveFileLookup", "true")
            found.append((reader.parquet(*plain), asked))
        if others := sorted(batches - indexed - singles):
            # Written by an older call, by one that broke off, or without hashes.
            rows = self.rows(name).filter(F.col("batch_id").isin(others) & F.col("content_hash").isNotNull())
            found.append((rows.select(F.unhex("content_hash").alias("hash")), asked))
        known = None if found else self.spark.createDataFrame([], "hash binary")
        for stored, wanted in found:
            part = stored.join(wanted, "hash", "left_semi")
            known = part if known is None else known.unionByName(part)
        try:
            # Few rows, of which a search for one uses only whether it is there.
            known = known if few else known.distinct()
            yield known.select(F.lower(F.hex("hash")).alias("content_hash"))
        finally:
            if not few:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _paths(folder: str, there: set[str], wanted: set[str]) -> list[str]:
    """The folder, or the batches in it where others are beside them."""
    if there <= wanted:
        return [folder]
    return [f"{folder}/batch_id={batch}" for batch in sorted(there & wanted)]


def _binary_hashes(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("content_hash").isNotNull()).select(F.unhex("content_hash").alias("hash"))


class Ledger:
    """Keys of finished work (paths or titles), one appended Parquet file set per commit.

    An ingest publishes the keys together with its rows (``CollectionStore.keys``) and
    settles them here afterwards; what a crash in between leaves out, the next call settles.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "path"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def read(self) -> DataFrame:
        schema = f"{self.key} string"
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).distinct()

    def finished(self, store: CollectionStore, name: str) -> DataFrame:
        """What is committed here or was published with a batch of the collection."""
        published = store.keys(name, self.key).select(F.col("key").alias(self.key))
        return self.read().unionByName(published).distinct()

    def import_json(self, path: str) -> None:
        """Take over a ledger kept as one JSON array of keys."""
        array = F.from_json("value", "array<string>")
        keys = self.spark.read.text(path, wholetext=True).select(F.explode(array).alias(self.key))
        self.commit(keys)

    def entries(self, done: DataFrame) -> DataFrame:
        """Keys in the form in which a batch is published with them."""
        return done.select(F.lit(self.key).alias("kind"), F.col(self.key).cast("string").alias("key")).distinct()

    def settle(self, store: CollectionStore, name: str) -> None:
        """Commit the keys that batches of the collection were published with and that aren't here."""
        published = store.keys(name, self.key).select(F.col("key").alias(self.key))
        self.commit(published.join(self.read(), self.key, "left_anti"))

    def commit(self, done: DataFrame) -> None:
        """Append keys; a key that is appended again is read once."""
        done.select(self.key).distinct().write.mode("append").parquet(self.path)
