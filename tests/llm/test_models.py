"""Top-k search, language identification and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.common import SCHEMA, docs, empty, plain, rows, spaced
from walletgraph.llm import cover_tree, language

VECTORS = "vec_id long, embedding array<float>, label int, v string"


def vectors(spark, n, dim, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) * scale).astype(np.float32)
    x[n // 2 :] = x[n // 2 :].round(1)
    x[n // 4 : n // 2] = x[0]
    own = [(int(i), v.tolist(), 1, "x") for i, v in zip(rng.permutation(3 * n)[:n], x, strict=True)]
    bad = [(None, [1.0] * dim, 1, "x"), (50_000, None, 1, "x"), (50_050, [None] * dim, 1, "x"), (50_100, [float("nan")] * dim, 1, "x"), (50_150, [float("inf")] * dim, 1, "x"), (50_200, [], 1, "x")]
    return spark.createDataFrame([*own, own[3], *bad], VECTORS).repartition(3), {i: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for i, v, *_ in own}


def brute(own, k, every):
    ids = np.array(sorted(own))
    m = np.array([own[i] for i in ids])
    out = []
    for q in ids[ids % every == 0]:
        score = m @ own[q]
        best = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out += [(int(q), r + 1, int(ids[j]), int(score[j])) for r, j in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("n,dim,block,group,scale", [(300, 8, 8192, 16384, 1), (300, 2, 64, 4, 1), (4, 3, 8192, 16384, 1), (200, 4, 50, 8, 1e6)])
def test_top_k(spark, n, dim, block, group, scale):
    df, own = vectors(spark, n, dim, n + dim, scale)
    out = cover_tree.top_k(df, every=5, block=block, group=group)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, out.collect())) == brute(own, 5, 5)


def test_top_k_empty(spark):
    assert cover_tree.top_k(spark.createDataFrame([], VECTORS)).collect() == []
    assert cover_tree.top_k(spark.createDataFrame([(0, [1.0, 2.0], 1, "")], VECTORS)).collect() == []


def clustered(seed=3, n=200):
    rng = np.random.default_rng(seed)
    return np.floor(np.repeat(rng.normal(size=(20, 6)) * 500, n, axis=0) + rng.normal(size=(20 * n, 6)) * 5)


def test_tree_levels():
    points = clustered()
    tree = cover_tree.CoverTree(points)
    away = lambda x, y: np.sqrt(((x - y) ** 2).sum(axis=-1))
    for i, below in enumerate(tree.below):
        assert len(below) == 0 or away(points[below], tree.centre[i]).max() <= tree.radius[i] + 1e-9
        own = tree.children[i]
        if own:
            scale = 2.0 ** (tree.level[i] - 1)
            assert (tree.centre[own[0]] == tree.centre[i]).all()  # nesting
            assert all(away(tree.centre[c], tree.centre[i]) <= 2 * scale for c in own)  # covering
    for level in sorted({tree.level[i] for i, own in enumerate(tree.children) if own}):
        net = np.unique([tree.centre[i] for i, own in enumerate(tree.children) if own and tree.level[i] == level for i in own], axis=0)
        apart = away(net[:, None], net[None, :]) + np.diag(np.full(len(net), np.inf))
        assert apart.min(initial=np.inf) > 2.0 ** (level - 1)  # separation
    assert len(tree.children[0]) > 1 and sorted(np.concatenate([x for x in tree.own if x is not None]).tolist()) == list(range(len(points)))


def test_tree_prunes():
    points, ids = clustered(), np.arange(4000)
    q = points[::5]
    got, names, scores, seen = cover_tree.search(q, ids[::5], points, ids, 5)
    assert seen < 0.2 * len(q) * len(points)
    least = np.array([np.sort(points @ x)[-6] for x in q]).astype(np.int64)  # with the query's own row
    again = cover_tree.search(q, ids[::5], points, ids, 5, least)
    assert again[3] <= seen and sorted(zip(again[0], again[1], strict=True)) == sorted(zip(got, names, strict=True))


def test_cells_are_left_out():
    """Of far-apart cells, only those that may hold a best vector meet a chunk."""
    from types import SimpleNamespace as Row

    pivots = {2: np.array([[1000.0, 0], [0, 1000.0], [-1000.0, 0]])}
    stats = [Row(dim=2, cell=i, n=100, radius=10.0, asked=5, reach=10.0) for i in range(3)]
    chunks = cover_tree._chunks([(2, i, 5) for i in range(3)], 5)
    floors = {(2, i, i): 980_000 for i in range(3)}
    assert cover_tree._meetings(stats, chunks, floors, pivots) == [(2, 0, 0), (2, 1, 1), (2, 2, 2)]
    assert len(cover_tree._meetings(stats, chunks, {}, pivots)) == 9


def test_scores_that_do_not_fit(spark):
    with pytest.raises(ValueError, match="fit"):
        cover_tree.top_k(spark.createDataFrame([(0, [1e15] * 4, 1, ""), (1, [1e15] * 4, 1, "")], VECTORS))


def corpus(spark, n=240):
    rng = random.Random(5)
    words = {"aa": ["alba", "aroma", "banana", "sala"], "ee": ["bebé", "leden", "weed", "fleece"], "oo": ["moon", "soon", "bröd", "foot"]}
    own = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 40))), lang if i % 7 else None, "s", 1, "b", 1) for i, lang in enumerate(rng.choices(list(words), k=n))]
    odd = [(1000, None, "aa", None, None, None, None), (1001, "", "aa", None, None, None, None), (1002, "12 !? ²", "ee", None, None, None, None), (None, "moon soon", "oo", None, None, None, None), (1003, "moon " * 300_000, None, None, None, None, None), own[4]]
    return spark.createDataFrame([*own, *odd], SCHEMA).repartition(4), own


def test_language(spark):
    df, own = corpus(spark)
    model = language.fit(df)
    assert model.labels == ["aa", "ee", "oo"]
    out = language.predict(df, model).collect()
    assert len(out) == len(own) + 6
    got = {r.doc_id: r for r in out}
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[None].held_out is False and got[None].lang_pred == got[1003].lang_pred == "oo"
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in out if r.doc_id is not None)
    held = [(got[i].lang_pred, lang) for i, _, lang, *_ in own if lang and got[i].held_out]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.98
    kept = language.identified(df, model, 1.0)
    assert kept.schema == df.schema and {1000, 1001, 1002}.isdisjoint(r.doc_id for r in kept.collect()) and kept.count() == len(out) - 3


def test_learns_from_the_rest_only(spark):
    df, own = corpus(spark)
    lies = spark.createDataFrame([(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, *rest) for i, t, lang, *rest in own], SCHEMA)
    assert "zz" not in language.fit(lies).labels


def test_no_language_is_lost(spark):
    """Whatever id a row with thousands of copies has, and however many null or letterless texts there are."""
    few = [(100 + i, f"leden weed {i}", "ee", *(None,) * 4) for i in range(30)]
    blank = [(1000 + i, None if i % 2 else "12 34", "ee", *(None,) * 4) for i in range(2000)]
    for i in (0, 1, 2, 3, 5, 6):
        if zlib.crc32(str(i).encode()) % 3 == 1:
            continue
        df = spark.createDataFrame([(i, "alba aroma", "aa", *(None,) * 4)] * 3000 + few + blank, SCHEMA).repartition(4)
        assert language.fit(df).labels == ["aa", "ee"]


def test_every_language_of_many(spark):
    own = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} " * 5, f"l{i:04d}", *(None,) * 4) for i in range(3000)]
    held = sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(3000))
    assert len(language.fit(spark.createDataFrame(own, SCHEMA).repartition(8)).labels) == 3000 - held


def test_plain_kernel_ridge():
    """With all texts as landmarks the model is kernel ridge regression on the plain kernel."""
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdé" if i % 2 else "cdefg", k=4)) for _ in range(6)) for i in range(40)]
    labels = ["xy"[i % 2] for i in range(40)]

    def grams(text):
        data = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
        return {data[i : i + n] for n in (1, 2, 3) for i in range(len(data) - n + 1)}

    presence = np.zeros((40, language.SPACE), np.uint8)
    for row, text in zip(presence, texts, strict=True):
        language.fill(row, np.frombuffer(text.encode(), np.uint8))
    assert [len(grams(t)) for t in texts] == presence.sum(axis=1).tolist(), "columns are shared: choose other texts"
    model = language.Model(presence[:30], labels[:30])
    kernel = lambda a, b: np.array([[len(grams(x) & grams(y)) / np.sqrt(len(grams(x)) * len(grams(y))) for y in b] for x in a])
    values, vectors = np.linalg.eigh(kernel(texts[:30], texts[:30]))
    root = vectors / np.sqrt(values)
    z, held = (np.c_[kernel(x, texts[:30]) @ root, np.ones(len(x))] for x in (texts[:30], texts[30:]))
    y = np.array([[1.0 if x == label else -1.0 for x in "xy"] for label in labels[:30]])
    margin = held @ np.linalg.solve(z.T @ z + language.RIDGE * np.eye(z.shape[1]), z.T @ y)
    share = np.exp(language.SHARPNESS * margin) / np.exp(language.SHARPNESS * margin).sum(axis=1, keepdims=True)
    top, best, ahead = model.classify(presence[30:])
    assert top.tolist() == margin.argmax(axis=1).tolist()
    assert np.allclose(best, share.max(axis=1), atol=1e-3) and np.allclose(ahead, share.max(axis=1) / share.min(axis=1), rtol=1e-2)


def test_accuracy_on_documents(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    got = language.predict(df, language.fit(df)).where("held_out").join(df.select("doc_id", "lang"), "doc_id").where("lang is not null").select("lang", "lang_pred").collect()
    assert len(got) > 40 and np.mean([r.lang == r.lang_pred for r in got]) >= 0.95


def test_unknown_languages_go(spark):
    """The stage removes texts in scripts and letters that no learned language has, and no others."""
    import corpus_pipeline as P

    df, _ = corpus(spark)
    odd = spark.createDataFrame([(5000, "ψφω ξζθ " * 20, *(None,) * 5), (5001, "лдж шщъ " * 20, *(None,) * 5), (5002, "漢字仮名" * 20, *(None,) * 5)], SCHEMA)
    kept = {r.doc_id for r in P.identify_language(spark, df.unionByName(odd), "").collect()}
    assert kept == {r.doc_id for r in df.collect()} - {1000, 1001, 1002}


def worded(r, words, n):
    return " ".join(r.choice(words) for _ in range(n)).capitalize() + "."


def test_letters_without_a_language_go(spark):
    """Random letters, hex and base64 go; real languages, mixed, very short and very long texts stay, and nothing changes for predict()."""
    import corpus_pipeline as P

    r = random.Random(5)
    words = {x: ["".join(r.choice(c) + r.choice(v) for _ in range(r.randrange(1, 4))) + r.choice(["", "n", "s"]) for _ in range(80)] for x, c, v in (("p", "bcdflmnst", "aeio"), ("q", "ghkrstvw", "aeuy"), ("s", "dklmnprt", "äöaui"))}
    own = [(i, worded(r, words["pqs"[i % 3]], r.randrange(30, 200)), "pqs"[i % 3], *(None,) * 4) for i in range(240)]
    good = [worded(r, words["p"], 40) + " " + worded(r, words["q"], 60), worded(r, words["s"], 2), worded(r, words["q"], 100_000), "12 34 " * 50 + worded(r, words["p"], 40)]
    letters, code = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    bad = [f(n) for n in (300, 3000, 200_000) for f in (
        lambda n: " ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 9))) for _ in range(n // 5)),
        lambda n: "".join(r.choice("0123456789abcdef") for _ in range(4 * n)),
        lambda n: "".join(r.choice(code) for _ in range(n)),
    )]
    rest = [(1000 + i, x, None, *(None,) * 4) for i, x in enumerate(good)] + [(2000 + i, x, None, *(None,) * 4) for i, x in enumerate(bad)]
    df = spark.createDataFrame(own + rest, SCHEMA).repartition(5)
    kept = {x.doc_id for x in P.identify_language(spark, df, "").select("doc_id").collect()}
    assert kept >= {x[0] for x in own} and kept & set(range(1000, 2000)) >= {1001, 1002, 1003}
    assert not any(i >= 2000 for i in kept)
    plain, more = language.fit(df), language.fit(df, noise=True)
    assert not plain.least_usual and set(more.least_usual) == {"p", "q", "s"} and np.array_equal(plain.weights, more.weights)


def test_usual_share_against_counting():
    r = random.Random(6)
    texts = ["".join(r.choice("abcé 1,") for _ in range(60)) for _ in range(30)]
    presence = np.zeros((30, language.SPACE), np.uint8)
    for row, text in zip(presence, texts, strict=True):
        language.fill(row, np.frombuffer(text.encode(), np.uint8))
    model = language.Model(presence, ["x"] * 25 + ["y"] * 5)
    assert set(model.usual) == {"x"}
    fold = lambda text: bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    runs = lambda text: [t for t in (fold(text)[i : i + 3] for i in range(len(fold(text)) - 2)) if 32 not in t]
    usual = {t for t in {t for x in texts for t in runs(x)} if sum(t in fold(x) for x in texts[:25]) >= 0.05 * 25}
    for text in [*texts, "abc", "", "zzz" * 9]:
        own, want = runs(text), None
        if len(own) >= language.LEAST_RUNS:
            want = sum(t in usual for t in own) / len(own)
        assert model.usual_share(np.frombuffer(text.encode(), np.uint8), "x") == want
    assert model.usual_share(np.frombuffer(texts[0].encode(), np.uint8), "y") is None


def test_nothing_to_learn(spark):
    assert language.fit(empty(spark)) is None
    df, _ = corpus(spark, 20)
    assert {(r.lang_pred, r.score) for r in language.predict(df, None).collect()} == {("und", 0.0)}
    assert language.predict(empty(spark), None).collect() == []


def test_unlabelled_corpus_stays(spark):
    import corpus_pipeline as P

    df = docs(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = P.identify_language(spark, df, "")
    assert kept.schema == df.schema
    letters = [r[:2] for r in rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert 0 < len(letters) < len(rows()) and sorted(map(repr, map(tuple, kept.select("doc_id", "text").collect()))) == sorted(map(repr, letters))


def test_pipeline(spark, tmp_path):
    """Each stage against the plain form of what it decides, on what the one before kept."""
    import corpus_pipeline as P
    from tests.llm import test_jaccard, test_repeats

    docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    passage = " ".join(spaced(rows()[8][1])[:14])
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    assert [n for n, _ in P.STAGES] == ["language", "near_copies", "repeats", "benchmark", "packing"]
    for name, stage in P.STAGES:
        out = stage(spark, df, str(tmp_path))
        if name != "packing":
            assert out.schema == df.schema
        out.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        seen.append([tuple(r) for r in df.collect()])
    known, near, cut, clean, packed = seen
    letters = [r for r in rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert {r[0] for r in known} <= {r[0] for r in letters} and len(known) >= 0.9 * len(letters)
    gone = {i for i, _, c in test_jaccard.brute(known, 5, 80, 100) if i is not None and i != c}
    assert sorted((r[0] for r in near), key=repr) == sorted((r[0] for r in known if r[0] not in gone), key=repr)
    want = {i: n - k for i, n, k, _ in test_repeats.brute(near, 50)}
    assert {r[0]: len(spaced(r[1])) for r in cut} == {i: n for i, n in want.items() if n}
    assert not any(" ".join(plain(passage)[:10]) in " ".join(plain(r[1])) for r in clean) and {r[0] for r in clean} <= {r[0] for r in cut}
    assert {r[0] for r in packed} == {r[0] for r in clean}
    assert P.run(spark, str(tmp_path)).count() == len(packed)


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Every stage on empty tables, and on null ids, texts and languages with clashing column names."""
    import corpus_pipeline as P

    benchmark = spark.createDataFrame([(1, " ".join(spaced(rows()[8][1])[:14])), (None, "moon"), (2, None), (3, "!")], "item_id long, text string")
    names = "__bucket string, own_id int, own_print int, gone int, label string, print int"
    for turn, (df, items) in enumerate((
        (empty(spark), benchmark.limit(0)),
        (spark.createDataFrame([(None,) * 7, (1, None, *(None,) * 5), (1, "", *(None,) * 5)], SCHEMA), benchmark),
        (docs(spark).selectExpr("*", *(f"cast(1 as {t}) as {c}" for c, t in (x.split() for x in names.split(", ")))), benchmark),
    )):
        folder = tmp_path / str(turn)
        items.write.parquet(str(folder / "benchmark.parquet"))
        df.write.parquet(str(folder / "documents.parquet"))
        own = spark.read.parquet(str(folder / "documents.parquet"))
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, own, str(folder))
            assert out.schema == own.schema
            assert 0 < out.count() <= own.count() if turn == 2 or turn == 1 and name != "language" else out.count() == 0, name
        packed = P.STAGES[-1][1](spark, own, str(folder)).collect()
        assert len(packed) >= own.count() and {r.doc_id for r in packed} == {r.doc_id for r in own.collect()}
        assert turn == 1 or (P.run(spark, str(folder)).count() > 0) == (turn == 2)


def test_registered():
    import __spark_entry__
    from walletgraph.llm import catalog

    assert set(catalog.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(x[2:].split("_")[0]) for x in catalog.QUERIES) == list(range(1, 14))
