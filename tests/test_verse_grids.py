"""The verse classifiers' own grids: what the registered query searches, and that a point's settings reach its classifier."""

from quarry.plans import catalog
from quarry.plans import jobs as jb


def test_the_forest_query_searches_the_jobs_whole_grid(monkeypatch):
    asked = []
    monkeypatch.setattr(catalog, "_quality_docs", lambda spark, root: None)
    monkeypatch.setattr(jb, "verse_classifier_job", lambda docs, kind, grid=None, folds=jb.FOLDS: asked.append((kind, grid or jb.VERSE_GRIDS[kind], folds)))
    catalog.QUERIES["verse_classifier_forest"](None, "")
    assert asked == [("forest", jb.VERSE_GRIDS["forest"], 10)]
    assert len(jb.grid_points(asked[0][1])) == 18


def test_each_point_is_fitted_with_its_own_settings(spark):
    words = {"a": ["apple", "pear", "plum", "cherry"], "b": ["iron", "zinc", "lead", "copper"]}
    docs = [(i, "\n".join(" ".join(words[y][(i + j + k) % 4] for k in range(3)) for j in range(4)), y)
            for i, y in enumerate(["a", "b"] * 20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, label string")
    grid = {"sentencesInVerse": [4], "vectorSize": [4], "numTrees": [3], "maxDepth": [0, 4], "maxBins": [8]}
    got = {r["metric"]: r["value"] for r in jb.verse_classifier_job(df, "forest", grid, folds=2).collect()}
    at = "sentencesInVerse=4|vectorSize=4|numTrees=3|maxDepth={}|maxBins=8"
    assert set(got) == {at.format(0), at.format(4), "best_auc"}
    assert got[at.format(0)] == 0.5 < got[at.format(4)] == got["best_auc"]   # a tree without a split ranks nothing
