import random
import zlib

import duckdb
import pytest
from plain import LOWER, sha
from pyspark.sql import functions as F

from velometry.llm import merkle, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join(map(field, (doc_id, source, lang, n_chars, text))))


def tree(nodes):
    """The top, and of each node its siblings as (before, after) by level."""
    paths, spots, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for path, spot in zip(paths, spots):
            run = level[spot // 16 * 16 : spot // 16 * 16 + 16]
            path.append((run[: spot % 16], run[spot % 16 + 1 :]))
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
        spots = [s // 16 for s in spots]
    return level[0], paths


def expected(rows):
    """What the contract says, row by row."""
    null_first = lambda x: (x is not None, x if not isinstance(x, str) else x.encode())
    sources = sorted({r[3] for r in rows}, key=null_first)
    groups = {
        s: sorted((r for r in rows if r[3] == s), key=lambda r: (null_first(r[0]), leaf(*r)))
        for s in sources
    }
    built = {s: tree([leaf(*r) for r in own]) for s, own in groups.items()}
    root, tops = tree([built[s][0] for s in sources]) if sources else (None, [])
    out = []
    for s, top in zip(sources, tops):
        for row, path in zip(groups[s], built[s][1]):
            path = path + top
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1]:
                shown = (row[0], row[1].translate(LOWER), *row[2:])
            folded = leaf(*shown)
            for before, after in path:
                folded = sha("".join([*before, folded, *after]))
            proof = sha("".join("".join(b + a) for b, a in path))
            out.append((row[0], leaf(*row), built[s][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def got(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = queries.op13_merkle(spark, str(tmp_path)).select(*names).collect()
    return sorted((tuple(r) for r in found), key=str)


def documents(sizes, seed=1):
    rng = random.Random(seed)
    rows = [
        (rng.randrange(10**6), rng.choice(["Ab c", "é X", "", None, "plain"]), rng.choice(["en", None]), source, rng.choice([3, None]))
        for source, n in sizes.items()
        for _ in range(n)
    ]
    rng.shuffle(rows)
    return rows


def test_sources_of_all_sizes(spark, tmp_path):
    rows = documents({"a": 1, None: 17, "b": 16, "hot": 300, "": 2, "é": 33, "z": 1})
    assert got(spark, tmp_path, rows) == expected(rows)


@pytest.mark.parametrize("sizes", [{"one": 1}, {"a": 1, "b": 1}, {"only": 40}, {None: 3}])
def test_few_sources(spark, tmp_path, sizes):
    rows = documents(sizes, 2)
    assert got(spark, tmp_path, rows) == expected(rows)


def test_rounds_of_one_level(spark):
    """Several rounds, for leaves and for sources, which end in different ones."""
    rows = documents({"hot": 280, "b": 17, "c": 1, **{f"s{i}": 1 + i % 3 for i in range(20)}}, 3)
    leaves = merkle.leaves(spark.createDataFrame(rows, SCHEMA))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256"]
    found = merkle.manifest(leaves, depth=1).select(*names, "folded_root").collect()
    assert sorted((tuple(r[:5]) for r in found), key=str) == [r[:5] for r in expected(rows)]
    assert all(r.folded_root == r.root for r in found)


def test_nulls_ties_repeated_rows_and_other_columns(spark, tmp_path):
    rows = [(None, None, None, None, None)] * 2 + [(5, "A", "en", "s", 1)] * 20 + [(5, "B", "en", "s", 1)]
    wide = [(*r, "x", 7) for r in rows]
    found = got(spark, tmp_path, wide, SCHEMA + ", leaf string, `place` int")
    assert found == expected(rows)


def test_empty_table_and_long_text(spark, tmp_path):
    assert got(spark, tmp_path, []) == []
    rows = [(1, "Long " * 300_000, "en", "s", 3), (5, "", "en", "s", 0)]
    assert got(spark, tmp_path, rows) == expected(rows)


def test_paths_prove_and_tampering_shows(spark):
    rows = documents({"a": 40, "b": 5}, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    shown = merkle.leaves(df, {"text": F.concat(F.col("text"), F.lit("!"))})
    for row in merkle.manifest(shown, paths=True).collect():
        assert merkle.fold(row.leaf, row.path) == row.root
        assert sha("".join(row.path)) == row.proof_sha256
    assert {r[1] for r in rows} >= {None}
    changed = merkle.manifest(shown).filter("folded_root <> root").count()
    assert changed == sum(r[1] is not None for r in rows)


def test_one_changed_document_changes_the_root(spark):
    rows = documents({"a": 20, "b": 3}, 5)
    roots = set()
    for change in ("", "x"):
        rows[0] = (*rows[0][:2], change, *rows[0][3:])
        found = merkle.manifest(merkle.leaves(spark.createDataFrame(rows, SCHEMA)))
        roots |= {r.root for r in found.select("root").distinct().collect()}
    assert len(roots) == 2


def test_sql_knows_crc32():
    from velometry.llm.sql import crc32

    for n in (0, 7, 123456789, -3):
        found = duckdb.execute(f"select {crc32(repr(str(n)))}").fetchone()[0]
        assert found == zlib.crc32(str(n).encode())
