import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from arrears.llm import merkle_manifest
from arrears.llm.queries import op12_merkle_manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree(level):
    """Siblings (left, right) of every node up to the top, and the top."""
    paths, owner = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, p in zip(paths, owner):
            run = level[p // 8 * 8 : p // 8 * 8 + 8]
            path.append(("".join(run[: p % 8]), "".join(run[p % 8 + 1 :])))
        level, owner = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)], [p // 8 for p in owner]
    return paths, level[0]


def brute(rows):
    groups, found = {}, []
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    ordered = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in ordered:
        leaves = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), r) for r in groups[g]), key=lambda x: x[:3])
        found.append((leaves, *tree([x[2] for x in leaves])))
    out = []
    upper, root = tree([top for _, _, top in found]) if found else ([], None)
    for (leaves, paths, top), rest in zip(found, upper):
        for (_, _, leaf, row), path in zip(leaves, paths):
            now, path = dict(row), path + rest
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                now["text"] = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in row["text"])
            h = leaf_of(now)
            for left, right in path:
                h = sha(left + h + right)
            out.append((row["doc_id"], leaf, top, root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


def proved(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = merkle_manifest.manifest(docs, COLUMNS, changed={"text": merkle_manifest.lower_ascii(F.col("text"))}, where_changed=tampered)
    return merkle_manifest.verify(leaves).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, smoke_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()]
    got = rows_of(op12_merkle_manifest(spark, smoke_dir))
    assert got == brute(docs)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2, 4])
@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 600])
def test_blocks_of_any_height_give_one_tree(spark, levels, n):
    nodes = spark.range(n).selectExpr("'g' AS g", "id AS pos", f"{n}L AS n", "sha2(cast(id AS string), 256) AS node").cache()
    paths, top = tree([sha(str(i)) for i in range(n)])
    for r in merkle_manifest.climbed(nodes, ["g"], levels).collect():
        assert [tuple(s) for s in r.path] == paths[r.pos] and r.top == top
    nodes.unpersist()


def test_odd_rows(spark, odd_docs):
    more = spark.createDataFrame([(8, "Ä B", "", "a", 1), (9, "x", "é", "a", 1), (-3, "X", "Z", "", -1), (None, None, None, None, None), (None, "b", None, None, 7)], odd_docs.schema)
    docs = odd_docs.union(more)
    clashing = docs.selectExpr("*", "'x' AS grp", "1 AS node", "2 AS pos", "3 AS n", "4 AS _part", "5 AS path")
    assert rows_of(proved(clashing)) == brute([r.asDict() for r in docs.collect()])
    assert proved(docs.limit(0)).count() == 0
    one = docs.where("doc_id = 7")
    assert rows_of(proved(one)) == brute([r.asDict() for r in one.collect()])


def test_positions_do_not_depend_on_partitions(spark):
    """One group holds most rows, and one id most of them; equal rows are interchangeable."""
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) AS doc_id", "if(id % 7 = 0, 'b', 'a') AS lang", "'s' AS source", "id % 2 AS n_chars", "concat('T', id % 3) AS text")
    few, many = (rows_of(proved(docs.repartition(n))) for n in (1, 13))
    assert few == many == brute([r.asDict() for r in docs.collect()])


def test_no_group_is_one_partition(spark):
    """Rows are dealt by ranges and by blocks of neighbours, never by the group alone."""
    rows = spark.range(50_000).selectExpr("'a' AS grp", "id AS doc_id", "sha2(string(id), 256) AS node")
    spread = merkle_manifest.numbered(rows, ["grp"], ["doc_id"])
    assert spread.agg(F.max("pos"), F.countDistinct("pos")).first()[:] == (49_999, 50_000)
    plan = merkle_manifest.block_levels(spread, ["grp"])._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    dealt = [line for line in plan.splitlines() if "Exchange" in line]
    # Rows meet by group and block; the other shuffles are of the counts per partition.
    assert sum("_block" in line for line in dealt) == 1 and len(dealt) <= 4
    assert plan.index("_block") < plan.index("HashAggregate")
