"""Property tests: operators against plain-Python models on random data."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from martkit.operators import best_row_per_key, group_ordered_text, upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 3))
vals = st.one_of(st.none(), st.integers(-5, 5))


@SETTINGS
@given(st.lists(st.tuples(keys, vals, st.one_of(st.none(), st.text("ab ", max_size=3))), min_size=1, max_size=40))
def test_best_row_matches_row_number(spark, data):
    df = spark.createDataFrame([(k, v, t, i) for i, (k, v, t) in enumerate(data)], "k int, v int, t string, id int")
    got = best_row_per_key(df, ["k"], [F.col("v"), F.col("id")], ["id", "t"])
    w = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first(), "id")
    want = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("k", "id", "t")
    assert rows(got) == rows(want)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.text("xy", max_size=2))), min_size=1,
                max_size=40))
def test_ordered_text_paths_match_python(spark, data):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(data)], "k int, t string, id int")
    want = {}
    for i, (k, t) in enumerate(data):
        want.setdefault(k, [])
        if t is not None:
            want[k].append(t)
    want = {k: (",".join(v) if v else None) for k, v in want.items()}
    for chunk in (F.lit(0), F.floor(F.col("id") / 7)):
        got = group_ordered_text(df, ["k"], F.col("t"), [F.col("id")], ",", "s", chunk)
        assert dict(rows(got)) == want


def merge_model(target, source):
    """Dictionary MERGE: unique non-NULL target keys; source rows with a NULL
    key or a new key are inserted; matched keys take the source value."""
    out = {k: v for k, v in target}
    inserted = []
    for k, v in source:
        if k is not None and k in out:
            out[k] = v
        else:
            inserted.append((k, v))
    return sorted([(k, v) for k, v in out.items()] + inserted, key=repr)


@SETTINGS
@given(st.sets(st.integers(0, 6), max_size=5),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 99)), max_size=12))
def test_upsert_matches_merge_model(spark, tkeys, src):
    # Existing keys appear at most once in the source (several rows would fail by design).
    seen, source = set(), []
    for k, v in src:
        if k is not None and k in tkeys:
            if k in seen:
                continue
            seen.add(k)
        source.append((k, v))
    target = [(k, -k) for k in sorted(tkeys)]
    t = spark.createDataFrame(target, "k int, v int")
    s = spark.createDataFrame(source, "k int, v int")
    got = sorted(map(tuple, upsert(t, s, ["k"]).collect()), key=repr)
    assert got == merge_model(target, source)
