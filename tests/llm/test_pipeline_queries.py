"""The registered queries and the pipeline over the smallest tables."""

import duckdb
import pytest
from helpers import frame, prose, seeded

import __spark_entry__ as entry
import corpus_pipeline
from tripwise.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, want.fetchall()))


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_pipeline_over_a_made_up_corpus(spark, tmp_path):
    """Junk goes, copies leave one, leaks go, all else comes through, in shards."""
    rng = seeded(5)
    bench = [(i, prose(rng, 30)) for i in range(4)]
    rows, labels, good = [], [], []
    for i in range(400):
        text = prose(rng, rng.randint(60, 120))
        junk, leak = i % 5 == 0, i % 40 == 1
        if junk:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif leak:
            text += "\n" + bench[i % 4][1]
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not junk), 0))
        if not junk and not leak:
            good.append(i)
    copies = [(1000 + i, rows[i][1], "en", "s0", 1) for i in good[:30]]
    for name, df in (("documents", frame(spark, rows + copies, "doc_id long, text string, lang string, source string, n_chars long")),
                     ("labels", frame(spark, labels, "doc_id long, quality int, toxic int")),
                     ("benchmark", frame(spark, bench, "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
        sizes.append(docs.count())
    got = docs.toPandas()
    assert sorted(got.doc_id) == good
    assert sizes[1] == sizes[0] - 30 and sizes[2] == sizes[3] == sizes[4] == len(good)
    for _, g in got.groupby(["shard_id", "overflow"]):
        assert sorted(g.position) == list(range(len(g)))


def test_rest_works_without_the_subpackage():
    """Only the entry module guards the import, and only against the subpackage's absence."""
    assert "find_spec" in open(entry.__file__).read()
    for path in (entry.__file__, corpus_pipeline.__file__):
        assert "except ImportError" not in open(path).read()


CLASHES = "slot string, block int, mix_bytes int, mix_hash int, mix_row int, near_node int, keep_id int, whole_row int, `a.b` int, "\
          "shard_id int, overflow int, position int"


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Names that the operators use themselves come through unchanged; the last stage's own three replace the caller's."""
    rng = seeded(6)
    extra = ("s", -5, -7, 3, 4, 5, 6, 7, 8, 9, 10, 11)
    rows = [(i, prose(rng, 30), "en", f"s{i % 2}", 1, *extra) for i in range(12)]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES
    docs = spark.createDataFrame(rows, ddl)
    spark.createDataFrame([(1, prose(rng, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        own = [c for c in ddl_names(ddl) if name != "sharding" or c not in ("shard_id", "overflow", "position")]
        assert docs.columns == own + (["shard_id", "overflow", "position"] if name == "sharding" else [])
        kept = [f"`{c}`" for c in own]
        assert sorted(map(tuple, docs.select(*kept).collect())) == [r[:len(own)] for r in rows]


def ddl_names(ddl):
    return [c.split()[0].strip("`") for c in ddl.split(", ")]


def test_positions_in_a_shard_follow_the_mix(spark, tmp_path):
    rng = seeded(8)
    docs = frame(spark, [(i, prose(rng, 3000), "en", f"s{i % 3}", 1) for i in range(200)],
                 "doc_id long, text string, lang string, source string, n_chars long")
    corpus_pipeline.mixing_stage(spark, docs, "").write.parquet(f"{tmp_path}/mixed")
    mixed = spark.read.parquet(f"{tmp_path}/mixed")
    place = {r.doc_id: (r.f, r.n) for r in mixed.selectExpr("doc_id", "_metadata.file_path AS f", "_metadata.row_index AS n").collect()}
    sharded = corpus_pipeline.sharding_stage(spark, mixed, "").toPandas()
    assert sharded.groupby(["shard_id", "overflow"]).ngroups > 2
    for _, g in sharded.groupby(["shard_id", "overflow"]):
        assert list(g.sort_values("position").doc_id) == sorted(g.doc_id, key=place.get)
