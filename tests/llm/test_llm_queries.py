"""Queries of the subpackage against their SQL, and the invariants of those that SQL can't express."""

import importlib
import os
from collections import Counter

import pytest

from tests.oracle import compare
from tidelane import llm

FOLDER = "/root/testdata/sf0.001"
QUERIES = {n: q for m in llm.QUERY_MODULES for n, q in importlib.import_module(m).QUERIES.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_equals_sql(spark, name):
    compare(spark, FOLDER, *QUERIES[name])


def rows_of(spark, name):
    return QUERIES[name][0](spark, FOLDER).collect()


@pytest.fixture(scope="module")
def sizes(spark):
    """(doc_id, source, tokens) of all documents, by the other encoder of the same vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "text").collect()
    return [(d.doc_id, d.source, len(tokenizer.encode(d.text or "", add_special_tokens=False).ids)) for d in docs]


def test_packing_of_all_documents(spark, sizes):
    assert {r.doc_id for r in rows_of(spark, "p8_found")} == {d for d, _, n in sizes if n > 4096}
    of_doc, of_bin = Counter(), Counter()
    for r in rows_of(spark, "p8_packing"):
        of_doc[int(r.doc_id)] += r.tokens
        of_bin[r.bin] += r.tokens
    assert of_doc == Counter({d: n for d, _, n in sizes}) and max(of_bin.values()) <= 4096
    (report,) = rows_of(spark, "p8_fill")
    assert report.tokens == sum(of_bin.values()) and report.containers == len(of_bin)
    # No packing needs fewer containers than the tokens fill; this one needs at most a twentieth more.
    assert report.containers <= 1.05 * -(-report.tokens // 4096) + 1


def test_mixture_of_all_documents(spark, sizes):
    targets = {r.source: r for r in spark.read.parquet(f"{FOLDER}/mix_targets.parquet").collect()}
    total, have = sum(n for _, _, n in sizes), Counter()
    for _, source, n in sizes:
        have[source] += n
    missed = {s for s, t in targets.items() if have[s] * t.max_repeats < t.target_share * total}
    assert {r.source for r in rows_of(spark, "p9_found")} == missed
    used, size = Counter(), {d: n for d, _, n in sizes}
    for r in rows_of(spark, "p9_mixture"):
        assert 1 <= r.repeats <= targets[r.source].max_repeats and size[r.doc_id] == r.tokens
        used[r.source] += r.repeats * r.tokens
    for r in rows_of(spark, "p9_report"):
        assert r.reached == used[r.source] and r.missed == (r.source in missed)
        aim = targets[r.source].target_share * total
        assert r.reached == have[r.source] * r.max_repeats if r.missed else aim - max([n for _, s, n in sizes if s == r.source] or [0]) <= r.reached <= aim + 1


def test_scores_of_all_documents(spark):
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source").collect()}
    scores = rows_of(spark, "p10_scores")
    assert sorted(r.doc_id for r in scores) == sorted(docs) and all(0 <= r.probability <= 1 for r in scores)
    bad = {r.doc_id for r in scores if r.probability >= 0.5}
    assert {r.doc_id for r in rows_of(spark, "p10_found")} == bad
    rates = {r.source: r for r in rows_of(spark, "p10_rates")}
    assert {s: r.offending for s, r in rates.items() if r.offending} == dict(Counter(docs[d] for d in bad))
    assert sum(r.documents for r in rates.values()) == len(docs)


def test_session_and_recording_keys(spark):
    from pyspark.sql import functions as F

    from tidelane.llm.queries_records import recording_key, session_key

    sessions = ["2026-03-01_rig-04_s0001", "/data/sessions/2026-03-01_rig-04_s0001/", "2026-03-01_RIG-04_S0001", "2026-03-01 Rig 4 S001", "nas/20260301/2026-03-01_rig-04_s0001.session", "2026_03_01-RIG_04-s000001", "S0001@rig4@20260301", "20260301_rig04_s1", "rig-04/2026-03-01/s0001", "2026-03-01-rig-04-s0001  "]
    got = {r[0] for r in spark.createDataFrame([(s,) for s in sessions], "s string").select(session_key(F.col("s"))).collect()}
    assert got == {"20260301|4|1"}
    other = [r[0] for r in spark.createDataFrame([("2026-03-01_rig-14_s0001",), ("  ",), (None,), ("Lab ",)], "s string").select(session_key(F.col("s"))).collect()]
    assert other == ["20260301|14|1", None, None, "lab"]
    sources = ["rec_56af342a2e_0.mcap", "/data/raw/intake-58/REC_56AF342A2E_0.MCAP", "merged/rec_56af342a2e_0.mcap.zst"]
    assert {r[0] for r in spark.createDataFrame([(s,) for s in sources], "s string").select(recording_key(F.col("s"))).collect()} == {"56af342a2e"}


def test_stored_percentiles_near_the_threshold_are_followed_to_the_last_digit(spark, tmp_path):
    camera = "dataset string, camera_key string, channel int"
    values = [0.3 + i * 0.0001 for i in range(101)]
    samples = [(i, "d", "c", 0, 1, 0, v) for i, v in enumerate(values)] * 2 + [(900, "d", "c", 0, 1, 0, None), (901, "d", "c", 0, 1, 0, 7.0)]
    spark.createDataFrame(samples, f"sample_id long, {camera}, episode_index long, file_index long, luma double").write.parquet(f"{tmp_path}/camera_samples.parquet")
    exact = values[50]
    stored = [(1, exact + 0.1001), (2, exact + 0.0999), (3, exact - 0.1001), (4, exact - 0.0999), (5, exact + 0.3), (6, exact), (7, float("nan")), (8, None)]
    rows = [(i + k, "d", "c", scope, 1 if k else None, 0, None, None, q, None, None) for k, scope in ((0, "global"), (10, "episode")) for i, q in stored]
    spark.createDataFrame(rows, "stats_id long, dataset string, camera_key string, stats_scope string, episode_index long, channel int, q01 double, q10 double, q50 double, q90 double, q99 double").write.parquet(f"{tmp_path}/camera_stats.parquet")
    got = {tuple(r) for r in QUERIES["p4_found"][0](spark, str(tmp_path)).collect()}
    assert got == {(i + k, "q50") for i in (1, 3, 5, 7) for k in (0, 10)}
