"""Language identification: gradients, windows, held-out accuracy, hard rows."""

import zlib

import numpy as np

from ingot.llm import langid as L

D = "/root/testdata/sf0.01"


def plain_pooled(net, window):
    """Every filter at every place of a window, one at a time."""
    text, out = [b for b in window.tolist()], []
    x = net.p["embedding"][text]
    for w in L.WIDTHS:
        every = [x[i : i + w].ravel() @ net.p[f"filter{w}"] for i in range(L.WINDOW - w + 1)]
        out.append(np.max(every, 0) + net.p[f"bias{w}"])
    return np.maximum(np.concatenate(out), 0)


def test_pooling_sees_every_place_and_one_window():
    net, r = L.Network(["a", "b", "c"]), np.random.default_rng(1)
    windows = np.concatenate([L.windows_of(r.integers(0, 256, n).astype(np.uint8).tobytes()) for n in (700, 3, 249, 250)])
    assert windows.shape == (3 + 1 + 1 + 2, L.WINDOW) and (windows[:, -L._FILL :] == L._PAD).all()
    got = net.pooled(windows)
    for row, window in zip(got, windows):
        assert np.allclose(row, plain_pooled(net, window), atol=1e-4)


def test_gradient_by_differences():
    net, r = L.Network(["a", "b"]), np.random.default_rng(2)
    windows, y = np.concatenate([L.windows_of(r.integers(65, 91, 249).astype(np.uint8).tobytes()) for _ in range(6)]), np.array([0, 1, 0, 1, 1, 0])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(6), y]).mean()
    g = net.gradient(windows, y)
    for k, at in [("out", (3, 1)), ("out_bias", (0,)), ("filter3", (5, 2)), ("bias2", (4,)), ("embedding", (70, 1))]:
        old = net.p[k][at]
        net.p[k][at] = old + 1e-5
        up = loss()
        net.p[k][at] = old - 1e-5
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-4, k


def test_held_out_accuracy_and_the_fold(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    got = L.cross_identify(docs).collect()
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    assert len(got) == len(lang)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in lang[r["doc_id"]][1] or ""))
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]][0] for r in held]) > 0.97


def test_inputs_are_the_text_only(spark):
    """Other ids, labels and sources of the predicted rows change nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = L.train(docs)
    plain = {r["row"]["text"]: (r["lang_pred"], r["score"]) for r in L.identify(docs, net).collect()}
    other = docs.selectExpr("text", "'xx' AS lang", "-doc_id AS doc_id").repartition(7)
    for r in L.identify(other, net).collect():
        lang, score = plain[r["row"]["text"]]
        assert lang == r["lang_pred"] and abs(score - r["score"]) < 1e-5


def test_hard_rows(spark):
    train = [(i, t, la, 1) for i, (t, la) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 40)]
    rows = [(None, "und der Hund", None, 2), (1001, None, "en", 3), (1002, "", "en", 4), (1003, "12 34 ½ ² _ !", "de", 5), (1004, "the cat " * 40_000, None, 6), (1004, "the cat " * 40_000, None, 6), (1005, "漢", None, 7)]
    docs = spark.createDataFrame(train + rows, "doc_id long, text string, lang string, row int")
    got = [(r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in L.cross_identify(docs).where("doc_id IS NULL OR doc_id > 1000").collect()]
    by = {g[0]: g for g in got}
    assert len(got) == 7 and by[None][1] is False and by[None][2] == "de" and by[1004][2] == "en"
    assert all(by[i][2:] == ("und", 0.0) for i in (1001, 1002, 1003)) and by[1005][2] in ("en", "de")
    none = L.cross_identify(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang"))
    assert {(r["lang_pred"], r["score"]) for r in none.collect()} == {("und", 0.0)}
    assert L.cross_identify(docs.limit(0)).count() == 0


def test_training_set_is_bounded_and_balanced(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 200, "a" if i % 10 else "b") for i in range(900)], "doc_id long, text string, lang string")
    langs, x, y = L.training_windows(docs, most=100)
    assert langs == ["a", "b"] and len(x) == len(y) <= 100 and sorted(np.bincount(y).tolist()) == [50, 50]
    assert L.training_windows(docs, most=100, max_langs=1)[0] == ["a"]
