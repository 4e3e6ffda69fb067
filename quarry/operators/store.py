"""A stored index in segments (X1-X4, X7, X9, I5, I7, I9): a term dictionary, blocked postings, one commit point.

Layout below ``path``; every folder is written once and never changed:

* ``segments/{id}/blocks``   ``(gen, term_id, block, n, min_doc, max_doc, docs, tfs, positions)``: the postings of a term
  in one range of ``BLOCK_DOCS`` document ids as one row, ``docs`` being offsets in the range. Sorted by
  (term_id, block), so parquet statistics prune by term and by block. No row holds more than one range.
* ``segments/{id}/docs``     ``(gen, doc_id)``: documents with at least one raw token.
* ``dictionary/{id}``        ``(term, term_id)``: ids 1..n, given once and never changed; a delivery extends them.
* ``numbers/{id}``           ``(doc_id, doc_no)``: gap-free numbers 1..n of the documents in the order of their arrival.
* ``tombstones/{id}``        ``(doc_id, tgen)``: from generation ``tgen`` on, older rows of the document do not count.
* ``rejects/{id}``           ``(doc_id, reason, batch_id)``.
* ``manifests/g{n}.json``    generation n: the list of all of these that make up the index, and the counters.

A delivery stages its postings as blocks, grouped where the texts are read; these move once, by (term_id, block), and rows of one
block are joined where they arrive. It writes its folders, then its manifest; that last step is the commit. A reader takes the last manifest and sees all of a
delivery or nothing of it, whenever it looks and whatever is written beside it. A batch id that its source has committed already is
not written again, so a replay changes nothing: not the postings, not the term ids, not the numbers.

A document lives in one segment. If it is delivered again (or withdrawn) a tombstone hides its older rows. ``FANOUT``
segments of a level are merged to one of the next, without the hidden rows, so a reader opens at most ``FANOUT`` times
log(deliveries) segments; the lists of terms, numbers and tombstones are merged in the same way. One writer at a time:
a second one that commits the same generation gets an error and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.normalize import ALL_TECHNIQUES, Technique
from quarry.operators.index import TextIndex, build_blocks, repeated_ids, split_rejects
from quarry.plans.ordering import dense_index, nth_smallest
from quarry.session import delete_path, ensure_checkpoint_dir

BLOCK_BITS = 12
BLOCK_DOCS = 1 << BLOCK_BITS
FANOUT = 4
#: Kinds of lists that grow by a part per delivery.
LISTS = ("dictionary", "numbers", "tombstones", "rejects")
EMPTY = {"generation": 0, "segments": [], **{k: [] for k in LISTS}, "next_term": 1, "next_doc": 1, "sources": {}, "closed": None}
_STAGED = "term string, block bigint, docs array<int>, tfs array<bigint>, positions array<array<bigint>>"
_BLOCKS = ("gen bigint, term_id bigint, block bigint, n bigint, min_doc bigint, max_doc bigint, docs array<int>, tfs array<bigint>, "
           "positions array<array<bigint>>")
_SCHEMAS = {"blocks": _BLOCKS, "docs": "gen bigint, doc_id bigint", "dictionary": "term string, term_id bigint",
            "numbers": "doc_id bigint, doc_no bigint", "tombstones": "doc_id bigint, tgen bigint",
            "rejects": "doc_id bigint, reason string, batch_id bigint"}


class ConcurrentCommit(RuntimeError):
    """Another writer has committed this generation."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_manifest(spark: SparkSession, path: str, generation: int | None = None) -> dict:
    """The last manifest (or that of a generation); the empty one if nothing has been committed."""
    fs, folder = file_system(spark, f"{path}/manifests")
    if not fs.exists(folder):
        return json.loads(json.dumps(EMPTY))
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    names = [n for n in names if n.startswith("g") and (generation is None or n == f"g{generation:012d}.json")]
    if not names:
        return json.loads(json.dumps(EMPTY))
    return json.loads(spark.read.option("wholetext", True).text(f"{path}/manifests/{names[-1]}").first()[0])


def publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Write a manifest under its generation: the commit point. The file appears whole or not at all."""
    fs, final = file_system(spark, f"{path}/manifests/g{manifest['generation']:012d}.json")
    _, draft = file_system(spark, f"{path}/manifests/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise ConcurrentCommit(f"generation {manifest['generation']} of {path} exists")


def block_rows(postings: DataFrame, gen: int, key: str = "term_id") -> DataFrame:
    """Blocked postings from ``(key, doc_id, tf, positions)``."""
    entry = F.struct(F.col("doc_id").bitwiseAND(F.lit(BLOCK_DOCS - 1)).cast("int").alias("o"), "tf", "positions")
    # the rows move first: grouping them where they are read would sort a whole split, and few of its rows share a block
    grouped = (postings.withColumn("block", F.shiftright("doc_id", BLOCK_BITS)).repartition(key, "block").groupBy(key, "block")
               .agg(F.sort_array(F.collect_list(entry)).alias("e"), F.count(F.lit(1)).alias("n"),
                    F.min("doc_id").alias("min_doc"), F.max("doc_id").alias("max_doc")))
    return grouped.select(F.lit(gen).cast("bigint").alias("gen"), key, "block", "n", "min_doc", "max_doc",
                          F.col("e.o").alias("docs"), F.col("e.tf").alias("tfs"), F.col("e.positions").alias("positions"))


def doc_of(block, offset):
    return F.shiftleft(block, BLOCK_BITS) + offset


def entry_rows(blocks: DataFrame, key: str) -> DataFrame:
    """``(key, doc_id, tf, positions)`` of blocks, one row per posting (and ``gen``, if they have it)."""
    gen = [c for c in blocks.columns if c == "gen"]
    rows = blocks.select(*gen, key, "block", F.explode(F.arrays_zip("docs", "tfs", "positions")).alias("e"))
    return rows.select(*gen, key, doc_of(F.col("block"), F.col("e.docs")).alias("doc_id"), F.col("e.tfs").alias("tf"),
                       F.col("e.positions").alias("positions"))


def joined_blocks(rows: DataFrame, gen: int) -> DataFrame:
    """Blocks sorted by (term_id, block) from ``(term_id, block, docs, tfs, positions)`` rows that may share a term and a block, but no
    document in it. They move once, by range, and rows of one block then follow each other in a task, where they are joined."""

    def joined(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, blocks = table["term_id"].to_numpy(), table["block"].to_numpy()
        docs, tfs, positions = (table[c].combine_chunks() for c in ("docs", "tfs", "positions"))
        new = np.r_[True, (ids[1:] != ids[:-1]) | (blocks[1:] != blocks[:-1])]
        lengths = np.asarray(docs.value_lengths())
        ends = np.r_[np.flatnonzero(np.r_[True, new[1:]]), len(ids)]
        ends = np.r_[0, np.cumsum(lengths)][ends]
        docs, tfs, positions = docs.flatten(), tfs.flatten(), positions.flatten()
        offsets = docs.to_numpy()
        block_of = np.repeat(np.cumsum(new), lengths)
        if ((offsets[1:] < offsets[:-1]) & (block_of[1:] == block_of[:-1])).any():
            order = np.lexsort((offsets, block_of))
            docs, tfs, positions = (a.take(pa.array(order)) for a in (docs, tfs, positions))
            offsets = offsets[order]
        ids, blocks, bounds = ids[new], blocks[new], pa.array(ends.astype(np.int32))
        return pa.Table.from_arrays(
            [pa.array(np.full(len(ids), gen, np.int64)), pa.array(ids), pa.array(blocks), pa.array(np.diff(ends).astype(np.int64)),
             pa.array((blocks << BLOCK_BITS) + offsets[ends[:-1]]), pa.array((blocks << BLOCK_BITS) + offsets[ends[1:] - 1]),
             *(pa.ListArray.from_arrays(bounds, a) for a in (docs, tfs, positions))],
            names=[c.split()[0] for c in _BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ids, blocks = table["term_id"].to_numpy(), table["block"].to_numpy()
            if not len(ids):
                continue
            # before the last, maybe unfinished block
            other = np.flatnonzero((ids != ids[-1]) | (blocks != blocks[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from joined(table.slice(0, cut)).to_batches()
            held = table.slice(cut)
        if held is not None:
            yield from joined(held).to_batches()

    key = ["term_id", "block"]
    moved = rows.select(*key, "docs", "tfs", "positions").repartitionByRange(*key).sortWithinPartitions(*key)
    return moved.mapInArrow(run, _BLOCKS)


@dataclass(frozen=True)
class Snapshot:
    """One generation of a stored index. Everything read from it belongs to the same commit."""

    spark: SparkSession
    path: str
    manifest: dict

    def _read(self, kind: str) -> DataFrame:
        m = self.manifest
        folders = ([f"{self.path}/segments/{s['id']}/{kind}" for s in m["segments"]] if kind in ("blocks", "docs")
                   else [f"{self.path}/{kind}/{p['id']}" for p in m[kind]])
        return self.spark.read.schema(_SCHEMAS[kind]).parquet(*folders) if folders else self.spark.createDataFrame([], _SCHEMAS[kind])

    @property
    def blocks(self) -> DataFrame:
        """All blocks, hidden documents included."""
        return self._read("blocks")

    @property
    def dictionary(self) -> DataFrame:
        """``(term, term_id)`` of every term that was ever indexed."""
        return self._read("dictionary")

    @property
    def hidden(self) -> DataFrame | None:
        """``(doc_id, tgen)``: rows of older generations do not count; None if no segment holds such rows."""
        if not self.manifest["tombstones"]:
            return None
        return self._read("tombstones").groupBy("doc_id").agg(F.max("tgen").alias("tgen"))

    def live(self, rows: DataFrame) -> DataFrame:
        """The rows with ``gen`` and ``doc_id`` that count."""
        hidden = self.hidden
        if hidden is None:
            return rows
        h = hidden.select(F.col("doc_id").alias("__d"), "tgen")
        return rows.join(h, (F.col("doc_id") == F.col("__d")) & (F.col("gen") < F.col("tgen")), "left_anti")

    @property
    def docs(self) -> DataFrame:
        """``(doc_id)`` of the documents that count."""
        return self.live(self._read("docs")).select("doc_id")

    @property
    def numbers(self) -> DataFrame:
        """``(doc_id, doc_no)``: numbers 1..n in the order of arrival; a withdrawn document keeps its number."""
        return self._read("numbers")

    @property
    def rejects(self) -> DataFrame:
        return self._read("rejects")

    def id_postings(self, positions: bool = False, blocks: DataFrame | None = None) -> DataFrame:
        """``(gen, term_id, doc_id, tf[, positions])``, one row per document that counts."""
        cols = ["docs", "tfs"] + (["positions"] if positions else [])
        rows = (self.blocks if blocks is None else blocks).select("gen", "term_id", "block", F.explode(F.arrays_zip(*cols)).alias("e"))
        return self.live(rows.select("gen", "term_id", doc_of(F.col("block"), F.col("e.docs")).alias("doc_id"), F.col("e.tfs").alias("tf"),
                                     *([F.col("e.positions").alias("positions")] if positions else [])))

    def postings(self, blocks: DataFrame | None = None) -> DataFrame:
        """``(term, doc_id, positions, tf)`` as ``index.build_postings`` gives them."""
        # a term's name is looked up once a block, not once a posting
        named = (self.blocks if blocks is None else blocks).join(self.dictionary, "term_id")
        return self.live(entry_rows(named, "term")).select("term", "doc_id", "positions", "tf")

    def term_ids(self, words: Sequence[str]) -> dict[str, int]:
        """The ids of a bounded list of words."""
        found = self.dictionary.filter(F.col("term").isin(list(words))) if words else self.dictionary.limit(0)
        return {r["term"]: r["term_id"] for r in found.collect()}

    def lookup(self, term: str) -> DataFrame:
        """The postings of a term; the id is looked up first and pruned by in the blocks' scan."""
        ids = self.term_ids([term])
        found = self.blocks.filter(F.col("term_id") == F.lit(ids.get(term, 0)))
        return self.id_postings(True, found).select(F.lit(term).alias("term"), "doc_id", "positions", "tf")

    def id_stats(self) -> DataFrame:
        """``(term_id, df, cf)`` of the terms that some counted document holds. Without hidden rows, from the blocks' counts."""
        if self.hidden is None:
            total = F.aggregate("tfs", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
            return self.blocks.groupBy("term_id").agg(F.sum("n").cast("bigint").alias("df"), F.sum(total).cast("bigint").alias("cf"))
        return self.id_postings().groupBy("term_id").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))

    def term_stats(self) -> DataFrame:
        """``(term, df, cf)``."""
        return self.id_stats().join(self.dictionary, "term_id").select("term", "df", "cf")

    def index(self) -> TextIndex:
        """The same as a bundle of long-form tables."""
        return TextIndex(self.postings(), self.docs)


def snapshot(spark: SparkSession, path: str, generation: int | None = None) -> Snapshot:
    return Snapshot(spark, path, read_manifest(spark, path, generation))


def _write(df: DataFrame, path: str, *sort: str) -> None:
    if sort:
        df = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    df.write.parquet(path)


def _fresh_terms(staged: DataFrame, known: DataFrame) -> DataFrame:
    """``(term, fd, fp)``: first occurrences of the terms that the dictionary lacks."""
    head = F.struct(doc_of(F.col("block"), F.element_at("docs", 1)).alias("doc_id"), F.element_at(F.element_at("positions", 1), 1).alias("pos"))
    fresh = staged.filter(F.col("term").isNotNull()).groupBy("term").agg(F.min(head).alias("first")).join(known, "term", "left_anti")
    return fresh.select("term", F.col("first.doc_id").alias("fd"), F.col("first.pos").alias("fp"))


def _upto(staged: DataFrame, doc: int, pos: int | None = None) -> DataFrame:
    """Occurrences up to and including the document (or, of it, the position)."""
    kept = entry_rows(staged.filter(doc_of(F.col("block"), F.lit(0)) <= doc), "term").filter(F.col("doc_id") <= doc)
    if pos is not None:
        kept = kept.withColumn("positions", F.filter("positions", lambda p: (F.col("doc_id") < doc) | (p <= pos)))
        kept = kept.filter(F.size("positions") > 0).withColumn("tf", F.size("positions").cast("bigint"))
    return block_rows(kept, 0, "term").select(*staged.columns)


def commit(spark: SparkSession, path: str, docs: DataFrame, batch_id: int | None = None, source: str = "documents",
           withdrawn: DataFrame | None = None, techniques: Sequence[Technique] = ALL_TECHNIQUES, capacity: int | None = None,
           limit: int | None = None, fanout: int = FANOUT) -> dict:
    """Add a delivery of ``(doc_id, text)`` and return the manifest that holds it.

    A document that the index has is replaced, also by an empty or a rejected (null) text; ``withdrawn`` ``(doc_id)`` are taken out.
    Of several rows with one id the one with the greatest text stands. ``batch_id`` counts the deliveries of a ``source``; one that
    is not above the last committed is a replay and changes nothing. With ``capacity`` (I9) or ``limit`` (I5) the index takes
    documents in the order of batches, then ids, until its dictionary holds that many terms (cutting a document short)
    or that many documents have come; then it is closed, and later deliveries only count as seen.
    """
    ensure_checkpoint_dir(spark)
    m = read_manifest(spark, path)
    if batch_id is not None and batch_id <= m["sources"].get(source, -1):
        return m
    new = json.loads(json.dumps(m))
    gen = new["generation"] = m["generation"] + 1
    if batch_id is not None:
        new["sources"][source] = batch_id
    if m["closed"]:
        publish(spark, path, new)
        return new
    name, old = f"{gen:012d}-{uuid.uuid4().hex[:8]}", Snapshot(spark, path, m)
    staging = f"{path}/staging/{name}"

    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    good, rejects = split_rejects(docs)
    # texts move only if an id comes twice
    one = good.groupBy("doc_id").agg(F.max("text").alias("text")) if repeated_ids(good) else good
    build_blocks(one, BLOCK_BITS, techniques).write.parquet(f"{staging}/rows")
    staged = spark.read.schema(_STAGED).parquet(f"{staging}/rows")
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    ids = ids if withdrawn is None else ids.unionByName(withdrawn.select("doc_id"))
    rejects.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.parquet(f"{path}/rejects/{name}")

    def marked() -> DataFrame:
        rows = staged.filter(F.col("term").isNull()).select("block", F.explode("docs").alias("o"))
        return rows.select(doc_of(F.col("block"), F.col("o")).alias("doc_id"))

    marks = marked()
    first_time = marks.join(old.numbers, "doc_id", "left_anti")
    if limit is not None:
        cut = nth_smallest(first_time, ["doc_id"], limit - m["next_doc"] + 1)
        if cut is not None:
            staged, new["closed"] = _upto(staged, cut[0]), [cut[0], None]
    if capacity is not None:
        found = _fresh_terms(staged, old.dictionary)
        cut = nth_smallest(found, ["fd", "fp"], capacity - m["next_term"] + 1)
        if cut is not None:
            # a document's mark has position 0, so the cut document itself counts
            staged, new["closed"] = _upto(staged, *cut), list(cut)
    if new["closed"]:
        first_time = first_time.filter(F.col("doc_id") <= new["closed"][0])
        ids = ids.filter(F.col("doc_id") <= new["closed"][0])
    fresh = _fresh_terms(staged, old.dictionary).select("term")

    def numbered(rows: DataFrame, key: str, out: str, counter: str, kind: str) -> None:
        ranked = dense_index(rows, [key], "__rank").select(key, (F.col("__rank") + F.lit(m[counter] - 1)).alias(out))
        _write(ranked, f"{path}/{kind}/{name}", key)
        new[counter] += spark.read.schema(_SCHEMAS[kind]).parquet(f"{path}/{kind}/{name}").count()

    numbered(fresh, "term", "term_id", "next_term", "dictionary")
    numbered(first_time, "doc_id", "doc_no", "next_doc", "numbers")
    if m["segments"]:
        gone = old.docs.join(ids.distinct(), "doc_id", "left_semi").withColumn("tgen", F.lit(gen).cast("bigint"))
        _write(gone, f"{path}/tombstones/{name}", "doc_id")
        if not spark.read.schema(_SCHEMAS["tombstones"]).parquet(f"{path}/tombstones/{name}").isEmpty():
            new["tombstones"].append({"id": name, "level": 0, "gen": gen})
    for kind, counter in (("dictionary", "next_term"), ("numbers", "next_doc")):
        if new[counter] > m[counter]:
            new[kind].append({"id": name, "level": 0, "gen": gen})
    new["rejects"].append({"id": name, "level": 0, "gen": gen})

    after = Snapshot(spark, path, new)
    # blocks first, then ids: a term's name is looked up once a row of the staged blocks, not once a posting
    rows = staged.filter(F.col("term").isNotNull()).join(after.dictionary, "term")
    _write(joined_blocks(rows, gen), f"{path}/segments/{name}/blocks")
    kept = marked().select(F.lit(gen).cast("bigint").alias("gen"), "doc_id")
    _write(kept, f"{path}/segments/{name}/docs", "doc_id")
    if not spark.read.schema(_SCHEMAS["docs"]).parquet(f"{path}/segments/{name}/docs").isEmpty():
        new["segments"].append({"id": name, "level": 0, "gen": gen})
    publish(spark, path, new)
    delete_path(spark, staging)
    return compact(spark, path, fanout)


def _due(parts: list[dict], fanout: int) -> list[dict]:
    """The oldest ``fanout`` parts of the lowest level that has so many."""
    for level in sorted({p["level"] for p in parts}):
        same = [p for p in parts if p["level"] == level]
        if len(same) >= fanout:
            return sorted(same, key=lambda p: p["gen"])[:fanout]
    return []


def compact(spark: SparkSession, path: str, fanout: int = FANOUT) -> dict:
    """Merge segments and lists until no level holds ``fanout`` of them, each merge with a commit of its own. What the
    index says does not change; readers of older generations keep their folders (``vacuum`` removes them)."""
    m = read_manifest(spark, path)
    while True:
        kind = next((k for k in ("segments", *LISTS) if _due(m[k], fanout)), None)
        if kind is None:
            return m
        due = _due(m[kind], fanout)
        new = json.loads(json.dumps(m))
        new["generation"] += 1
        top = max(p["gen"] for p in due)
        name = f"{new['generation']:012d}-{uuid.uuid4().hex[:8]}"
        part = Snapshot(spark, path, m | {kind: due})
        if kind == "segments":
            rows = part.blocks if part.hidden is None else block_rows(part.live(entry_rows(part.blocks, "term_id")), top)
            _write(joined_blocks(rows, top), f"{path}/segments/{name}/blocks")
            _write(part.docs.select(F.lit(top).cast("bigint").alias("gen"), "doc_id"), f"{path}/segments/{name}/docs", "doc_id")
        elif kind == "tombstones":
            _write(part.hidden.select("doc_id", "tgen"), f"{path}/{kind}/{name}", "doc_id")
        else:
            _write(part._read(kind), f"{path}/{kind}/{name}", {"dictionary": "term"}.get(kind, "doc_id"))
        ids = {p["id"] for p in due}
        new[kind] = [p for p in m[kind] if p["id"] not in ids] + [{"id": name, "level": due[0]["level"] + 1, "gen": top}]
        # a tombstone is of no use once every segment is as young as it
        oldest = min((s["gen"] for s in new["segments"]), default=new["generation"])
        new["tombstones"] = [t for t in new["tombstones"] if t["gen"] > oldest]
        publish(spark, path, new)
        m = new


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove manifests but the last ``keep``, and folders that none of these names (left by merges, or by a delivery that failed
    before its commit). No writer may be at work. Returns the number of folders removed."""
    m = read_manifest(spark, path)
    kept = [read_manifest(spark, path, g) for g in range(max(1, m["generation"] - keep + 1), m["generation"] + 1)]
    removed = 0
    for kind in ("segments", *LISTS, "staging"):
        used = {p["id"] for k in kept for p in k.get(kind, [])}
        fs, folder = file_system(spark, f"{path}/{kind}")
        for s in fs.listStatus(folder) if fs.exists(folder) else []:
            if s.getPath().getName() not in used:
                fs.delete(s.getPath(), True)
                removed += 1
    fs, folder = file_system(spark, f"{path}/manifests")
    names = {f"g{k['generation']:012d}.json" for k in kept}
    for s in fs.listStatus(folder) if fs.exists(folder) else []:
        if s.getPath().getName() not in names:
            fs.delete(s.getPath(), False)
    return removed
