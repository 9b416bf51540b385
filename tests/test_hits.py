"""Hits with what their rows hold."""

from sparkloom.plans import catalog

CHUNK = "record_id bigint, title string, text string, series_id string"


def test_series_are_looked_up_for_hits_alone(spark, tmp_path, monkeypatch):
    """Rows that are no hit aren't shuffled: they are in no table that is written. A copy without its series hides none."""
    words = [f"{a}{b}" for a in "pqrstuvw" for b in "klmnopqr"]
    rows = [(i, words[i % 50] if i % 50 == 0 else "", words[i % 64] + " common", f"s{i % 7}") for i in range(1, 600)]
    rows += rows[::9] + [(i, t, x, None) for i, t, x, _ in rows[::50]]
    spark.createDataFrame(rows, CHUNK).coalesce(1).write.parquet(f"{tmp_path}/chunks.parquet")
    written = {}

    def keep(df, name, write=catalog.materialize):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(catalog, "materialize", keep)
    got = catalog.queries()["retrieval_scores"](spark, str(tmp_path)).collect()
    labels = {r.doc_id: r.label for r in written["labels"].collect()}
    assert len(got) == 1 and 0 < len(labels) <= 10 * len(got) and written["labels"].count() == len(labels)
    series = {i: s for i, _, _, s in rows[:599]}
    assert labels == {i: series[i] for i in labels}
