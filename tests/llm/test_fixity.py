import hashlib

from pyspark.sql import functions as F

from quireworks.llm import fixity


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest(spark, rows):
    return spark.createDataFrame(rows, "archive long, offset long, length long, sha256 string")


def test_roots_by_hand(spark):
    rows = [(a, o, 10, sha(f"{a}{o}")) for a in (0, 1) for o in (0, 70, 100, 450, 900)]
    levels = fixity.merkle_levels(manifest(spark, rows), (100, 400))
    for archive in (0, 1):
        leaves = {o: sha(f"{o}:10:{h}") for a, o, _, h in rows if a == archive}

        def up(nodes, width):
            groups = {}
            for n, h in sorted(nodes.items()):
                groups.setdefault(n // width, []).append(f"{n}:{h}")
            return {g: sha(",".join(x)) for g, x in groups.items()}

        nodes = up(up(leaves, 100), 4)
        root = sha(",".join(f"{n}:{h}" for n, h in sorted(nodes.items())))
        found = levels[-1].filter(F.col("archive") == archive).collect()
        assert [(r.node, r.hash) for r in found] == [(0, root)]


def test_audit_finds_all_damage(spark):
    rows = [(a, o * 13, 13, sha(f"{a} {o}")) for a in range(4) for o in range(200)]
    other = [r for r in rows if (r[0], r[1]) != (1, 26)]
    other = [(a, o, n, sha("x") if (a, o) in {(0, 0), (0, 13 * 199), (2, 13 * 77)} else h) for a, o, n, h in other]
    other.append((3, 13 * 200, 5, sha("more")))
    other += [(9, 0, 5, sha("an archive that the first has not"))]
    found = fixity.audit(manifest(spark, rows), manifest(spark, other), (64, 512)).collect()
    assert sorted(tuple(r) for r in found) == [
        (0, 0, "damaged"), (0, 13 * 199, "damaged"), (1, 26, "missing"), (2, 13 * 77, "damaged"),
        (3, 13 * 200, "extra"), (9, 0, "extra"),
    ]
    assert fixity.audit(manifest(spark, rows), manifest(spark, rows)).collect() == []


def test_messy_pages(spark):
    schema = "page_id long, url string, html string, archive string, offset string"
    rows = [(1, "u", "<p>é</p>", "x", "y"), (1, "u", "<p>é</p>", "x", "y"), (None, None, None, None, None), (2, None, "", "", ""),
            (3, "v", "z" * 300_000, "x", "y"), *((i, "h", f"<b>{i}</b>", None, None) for i in range(10, 900))]
    first, second, placed = fixity.replicas(spark.createDataFrame(rows, schema), 100)
    kept = placed.collect()
    assert len(kept) == len(rows) and max(r.seq for r in kept) == 99
    ends = {}
    for r in sorted(kept, key=lambda r: (r.archive, r.seq)):
        assert r.offset == ends.get(r.archive, 0)
        ends[r.archive] = r.offset + r.length
    wanted = {(r.archive, r.offset) for r in kept if r.lost or r.second != r.sha256}
    found = fixity.audit(first, second).collect()
    assert {(r.archive, r.offset) for r in found} == wanted and len(found) == len(wanted) > 3


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    first, second, _ = fixity.replicas(empty)
    assert fixity.audit(first, second).collect() == []
