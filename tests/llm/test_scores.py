"""Classifiers, URL filters and token counts: held-out accuracy, exact counts, awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from cohortscope.llm.quality import keep_good, score_quality, tree_rules
from cohortscope.llm.tokens import count_tokens
from cohortscope.llm.scratch import Scratch
from cohortscope.llm.toxicity import Field, marker_words, score_toxicity
from cohortscope.llm.urls import PRIOR, _with_statistics, judge_urls

SF_DIR = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.mark.parametrize(
    "score, label, folds, held, least",
    [(score_quality, "quality", 3, 1, 0.97), (score_toxicity, "toxic", 4, 2, 0.9)],
)
def test_held_out_accuracy(spark, score, label, folds, held, least):
    found = score(table(spark, "documents"), table(spark, "labels")).collect()
    known = {r.doc_id: r[label] for r in table(spark, "labels").collect()}
    assert len(found) == table(spark, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    right = [r.predicted == known[r.doc_id] for r in found if r.held_out and r.doc_id in known]
    assert len(right) > 50 and np.mean(right) >= least


def test_toxic_spans_lie_in_the_text(spark):
    docs = table(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = score_toxicity(docs, table(spark, "labels")).where("n_spans > 0").collect()
    assert spans
    for row in spans:
        for s in row.spans:
            word = texts[row.doc_id][s.start : s.stop]
            assert word and not word[0].isspace() and not word[-1].isspace() and " " not in word


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, None, None)], [(1, 1, 1), (4, 0, 0), (4, 1, 1), (None, 1, 1)]])
def test_awkward_documents(spark, awkward, nothing, score, labels):
    known = spark.createDataFrame(labels, LABELS)
    found = score(awkward, known).collect()
    assert len(found) == awkward.count()
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    assert score(nothing, known).count() == 0


def test_quality_filter_keeps_columns(spark, awkward):
    known = spark.createDataFrame([(1, 1, 0)], LABELS)
    kept = keep_good(awkward, known)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_rules_are_the_paths_of_the_trees():
    text = """Forest
  Tree 0 (weight 1.0):
    If (feature 0 <= 2.5)
     If (feature 1 <= 4.5)
      Predict: 0.0
     Else (feature 1 > 4.5)
      Predict: 1.0
    Else (feature 0 > 2.5)
     Predict: 0.0
"""
    assert tree_rules(text, ["a", "b"]) == ["a <= 2.5D", "a <= 2.5D AND b <= 4.5D", "a <= 2.5D AND b > 4.5D"]


def test_marginals_against_all_taggings():
    pick = np.random.default_rng(3)
    field = Field(pairs=pick.normal(size=(2, 2)))
    sizes = [3, 0, 5, 1]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    odds = np.exp(pick.normal(size=offsets[-1]))
    found = field.marginals(odds, offsets)
    for a, b in zip(offsets[:-1], offsets[1:]):
        total, hits = 0.0, np.zeros(b - a)
        for tags in np.ndindex(*[2] * (b - a)):
            weight = np.prod([odds[a + i] if t else 1 for i, t in enumerate(tags)])
            weight *= np.exp(sum(field.pairs[x, y] for x, y in zip(tags, tags[1:])))
            total += weight
            hits += weight * np.array(tags)
        assert np.allclose(found[a:b], hits / total)


def test_token_counts_and_cache(spark, awkward, nothing, tmp_path, monkeypatch):
    import public_tokenizers
    import sentencepiece

    from cohortscope.llm import tokens

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    cache = str(tmp_path / "cache")
    first = count_tokens(awkward, path, cache=cache, limit=100)
    expected = sorted(
        ((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in awkward.collect()),
        key=repr,
    )
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in first.collect()), key=repr) == expected
    assert all(r.over_limit == (r.n_tokens > 100) for r in first.collect())
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r.text or "" for r in awkward.collect()})
    # A second call finds every count in the cache and encodes nothing.
    monkeypatch.setattr(tokens, "sentencepiece_counter", lambda model: lambda text: 1 / 0)
    again = count_tokens(awkward, path, cache=cache, limit=100)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, first.collect()))
    assert spark.read.parquet(cache).count() == stored.count()
    assert count_tokens(nothing, path).count() == 0


def test_json_tokenizer(spark, awkward):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text or "" for r in awkward.where("doc_id NOT IN (2, 7)").collect() if r.doc_id}
    for r in count_tokens(awkward, path).collect():
        if r.doc_id in texts:
            assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_url_rules(spark):
    urls = {
        1: ("https://A.Example.ORG/es/x?y#z", "a.example.org", "/es/x", "example.org/es/", "block"),
        2: ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        3: ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        4: ("http://notexample.org", "notexample.org", "", None, None),
        5: ("ftp://b.com/de/#f", "b.com", "/de/", "com/de/", "block"),
        6: ("http://b.com/fr/?q", "b.com", "/fr/", "com/fr/", "allow"),
        7: ("b.com/fr/", "", "", None, None),
        8: (None, "", "", None, None),
        9: ("http://Ä.com?x=/fr/", "Ä.com", "", None, None),
        10: ("", "", "", None, None),
    }
    rows = [(i, u[0], "clash", "clash") for i, u in urls.items()] + [(None, None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    found = judge_urls(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        _, host, path, rule, verdict = urls.get(r.page_id, urls[8])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert judge_urls(pages.limit(0)).count() == 0
    one_kind = judge_urls(pages.where("page_id IN (3, 8)")).collect()
    assert {r.verdict for r in one_kind} == {"allow"}


def test_trees_agree_with_the_rules(spark):
    found = judge_urls(table(spark, "pages")).where("rule IS NOT NULL").collect()
    right = [(r.score >= 0.5) == (r.verdict == "block") for r in found]
    assert np.mean(right) > 0.85


def test_trees_on_urls_they_have_not_seen(spark):
    """A fifth of the hosts is held out of the learning; their rules' verdicts are the truth."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = judge_urls(pages, learn_from="pmod(crc32(host), 5) <> 0").where("rule IS NOT NULL")
    held = found.where("pmod(crc32(host), 5) = 0").collect()
    block = np.array([r.verdict == "block" for r in held])
    score = np.array([r.score for r in held])
    assert len(held) > 300 and np.mean((score >= 0.5) == block) > 0.7
    above = score[block][:, None] - score[~block][None, :]
    assert np.mean((above > 0) + 0.5 * (above == 0)) > 0.6


def test_unseen_suffixes_are_judged_by_their_features(spark):
    """Blocked hosts are long and full of digits; the suffixes of the judged URLs have no label."""
    pages = spark.range(1_200).selectExpr(
        "id AS page_id",
        "concat('http://', IF(id % 2 = 0, concat('a', id * 7919, '-', id * 104729, '.d'), 'home.d'), "
        "id % 30, IF(id % 3 = 0, '.net/p', '.com/p'), id % 11) AS url",
    )
    rules = [("block" if k % 2 == 0 else "allow", f"d{k}.com", "/") for k in range(30)]
    judged = judge_urls(pages, rules).where("rule IS NULL").collect()
    assert len(judged) == 400 and all(r.host.endswith(".net") for r in judged)
    assert np.mean([(r.verdict == "block") == (r.page_id % 2 == 0) for r in judged]) > 0.95


def test_a_label_is_not_among_its_own_features(spark):
    labelled = [("a", 0, 1.0), ("a", 0, 0.0), ("a", 1, 1.0), ("a", 4, 1.0), ("b", 2, 1.0)]
    rows = spark.createDataFrame([*labelled, ("a", None, None), ("c", None, None)], "top string, fold int, label double")
    found = _with_statistics(rows, rows.where("fold IS NOT NULL"), "top", 0.8).collect()
    for r in found:
        others = [y for t, f, y in labelled if t == r.top and f != r.fold]
        assert r.top_rate == pytest.approx((sum(others) + PRIOR * 0.8) / (len(others) + PRIOR))
        assert r.top_seen == pytest.approx(np.log(1 + len(others)))
    assert len(found) == 7


def test_hundreds_of_rules(spark):
    rules = [("block" if k % 2 else "allow", f"x{k}.com", "/") for k in range(400)]
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://x', id, '.com/') AS url")
    found = judge_urls(pages, rules).collect()
    assert all(r.rule == f"x{r.page_id}.com/" and (r.verdict == "block") == r.page_id % 2 for r in found)


RULES_SQL = """
    WITH parts AS (
        SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest
        FROM pages
    ), named AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM parts
    ), listed AS (
        SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
            ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS l(kind, h, p)
    )
    SELECT page_id, any_value(host), any_value(path), arg_max(h || p, length(h || p)), arg_max(kind, length(h || p))
    FROM named LEFT JOIN listed ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY page_id
"""


def test_hosts_paths_and_rules_against_sql(spark):
    import duckdb

    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS FROM '{SF_DIR}/pages.parquet'")
    expected = sorted(database.execute(RULES_SQL).fetchall())
    found = judge_urls(table(spark, "pages")).collect()
    given = sorted((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in found)
    assert given == expected


@pytest.mark.parametrize("tenths", [1, 4, 5, 8])
def test_markers_for_any_share_of_toxic_documents(spark, tenths):
    rows = spark.range(2_000).selectExpr(
        f"CAST(id % 10 < {tenths} AS INT) AS toxic",
        f"array(concat('a', id), IF(id % 10 < {tenths}, 'vile', 'kind'), concat('b', id), 'plain') AS words",
        "'.,' AS edges",
    )
    found = marker_words(rows, Scratch(spark, "test")).collect()
    assert [r.word for r in found] == ["vile"]


def test_no_marker_is_said(spark):
    docs = spark.createDataFrame([(i, "same words") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i // 8 % 2) for i in range(40)], LABELS)
    with pytest.warns(UserWarning, match="no word marks"):
        score_toxicity(docs, labels).collect()


def test_toxicity_keeps_ids_as_they_are(spark):
    labels = spark.createDataFrame([("1", 1)], "doc_id string, toxic int")
    large = spark.createDataFrame([(9007199254740993, "a b"), (None, "c"), (5, None)], "doc_id long, text string")
    found = score_toxicity(large.coalesce(1), labels.selectExpr("CAST(doc_id AS LONG) AS doc_id", "toxic"))
    assert {r.doc_id for r in found.collect()} == {9007199254740993, None, 5}
    named = spark.createDataFrame([("a", "a b"), (None, "c")], "doc_id string, text string")
    assert {r.doc_id for r in score_toxicity(named, labels).collect()} == {"a", None}
