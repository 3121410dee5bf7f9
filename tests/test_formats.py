"""The jobs on their original input formats, with small hand-made files."""

import random

from quarry.plans import jobs as jb
from quarry.sources import formats as fm


def _survey_csv(path):
    rng = random.Random(1)
    langs = fm.LANGUAGE_SLOTS[:5] + ["Go", ""]
    levels = list(fm.ENGLISH_LEVELS) + ["unknown"]
    head = [c.split()[0] for c in fm.SURVEY_SCHEMA.split(", ")]
    lines = [",".join(head)]
    for i in range(120):
        pos = rng.choice(["Software Engineer", "Technical Lead", "System Architect", "Designer"])
        exp = round(rng.uniform(0, 10), 1)
        sal = int(800 + 300 * exp + rng.uniform(-200, 200))
        row = [i, "Kyiv", sal, 0, pos, exp, 1.0, rng.choice(langs), "", 30, "m", "", "", "false",
               rng.choice(levels), "", "", ""]
        lines.append(",".join(str(x) for x in row))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_survey_salary_job_slots(spark, tmp_path):
    out = jb.survey_salary_job(spark, _survey_csv(tmp_path / "s.csv"), folds=3)
    names = [r["name"] for r in out.collect()]
    slots = [n for n in names if n.startswith("programming_language=")]
    assert len(slots) == 19 and slots[11] == "programming_language=Other"
    assert "intercept" in names and "experience" in names


def test_survey_levels_job(spark, tmp_path):
    out = jb.survey_levels_job(spark, _survey_csv(tmp_path / "s.csv"))
    assert sorted(r["level"] for r in out.collect()) == ["junior", "middle", "senior"]


def test_product_csv_job(spark, tmp_path):
    rng = random.Random(2)
    lines = [",".join(["id"] + fm.product_features(5) + ["target"])]
    for i in range(90):
        t = rng.choice(["Class_1", "Class_2"])
        base = 3 if t == "Class_1" else 0
        lines.append(",".join([str(i)] + [str(base + rng.randint(0, 2)) for _ in range(5)] + [t]))
    p = tmp_path / "p.csv"
    p.write_text("\n".join(lines) + "\n")
    out = {r["metric"]: r["value"] for r in jb.product_csv_job(spark, str(p), folds=3, n_features=5).collect()}
    assert out["accuracy"] > 0.8


def test_text_csv_job(spark, tmp_path):
    rng = random.Random(3)
    words = {"rock": ["guitar", "loud", "stage", "drum"], "pop": ["dance", "love", "radio", "star"]}
    lines = ["genre,lyrics"]
    for _ in range(80):
        g = rng.choice(list(words))
        text = " ".join(rng.choice(words[g]) for _ in range(6)) + " and more"
        lines.append(f"{g},{text}")
    p = tmp_path / "t.csv"
    p.write_text("\n".join(lines) + "\n")
    out = {r["metric"]: r["value"] for r in jb.text_csv_job(spark, str(p), folds=2).collect()}
    assert out["accuracy"] > 0.8


def test_text_dirs_verse_job(spark, tmp_path):
    rng = random.Random(4)
    words = {"rock": ["guitar", "loud", "stage", "drum"], "pop": ["dance", "love", "radio", "star"]}
    for g, ws in words.items():
        d = tmp_path / g
        d.mkdir()
        for i in range(12):
            lines = [" ".join(rng.choice(ws) for _ in range(5)) for _ in range(8)]
            (d / f"{i}.txt").write_text("\n".join(lines))
    dirs, path = {g: str(tmp_path / g / "*") for g in words}, str(tmp_path / "model")
    out = {r["metric"]: r["value"] for r in jb.text_dirs_verse_job(
        spark, dirs, folds=2, grid={"sentencesInVerse": [2, 4]}, model_path=path).collect()}
    assert out["best_auc"] > 0.9 and len(out) == 3
    # the saved model answers requests: one row and one class map per text
    req = spark.createDataFrame([(1, "guitar loud drum\nstage loud"), (2, "dance love radio")], "doc_id int, text string")
    got = {r["doc_id"]: r for r in jb.verse_predictions_job(spark, req, path).collect()}
    assert {k: r["predicted_label"] for k, r in got.items()} == {1: "rock", 2: "pop"}
    assert set(got[1]["class_probabilities"]) == {"rock", "pop"}
    again = {r["doc_id"]: r for r in jb.verse_predictions_job(spark, req, path).collect()}
    assert again == got


def test_multiclass_reports_and_predictions(spark, tmp_path):
    rng = random.Random(6)
    words = {"rock": ["guitar", "loud", "stage", "drum"], "pop": ["dance", "love", "radio", "star"], "folk": ["hills", "river", "añil", "été"]}
    rows = [(i, " ".join(rng.choice(ws) for _ in range(12)), g) for i, (g, ws) in enumerate(list(words.items()) * 20)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    out = jb.multiclass_text_reports(docs, "nb", folds=2)
    assert out["overview"].first()["n_rows"] == 60
    assert {r["lang"]: r["n"] for r in out["classes"].collect()} == {"rock": 20, "pop": 20, "folk": 20}
    conf = out["confusion"].collect()
    right = sum(r["n"] for r in conf if r["lang"] == r["predicted"])
    assert right > 0.8 * sum(r["n"] for r in conf) and out["sample"].count() <= 20
    req = spark.createDataFrame([(1, "river hills été"), (2, "drum guitar loud")], "doc_id int, text string")
    for _ in range(2):  # trained once, then loaded
        got = {r["doc_id"]: r for r in jb.multiclass_text_predictions(spark, docs, req, str(tmp_path / "m"), folds=2).collect()}
        assert {k: r["predicted"] for k, r in got.items()} == {1: "folk", 2: "rock"}
        assert set(got[1]["class_probabilities"]) == set(words)
