from leaguelake import session


def test_landed_files_of_large_tables_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    text = f"{tmp_path}/landed"
    spark.range(0, 4000, 1, 40).selectExpr("cast(id as string) AS value").write.option("compression", "lz4").text(text)
    settings = (session.FIRST_PARTITIONS, *session.LEAST_PARTITIONS)
    before = {s: spark.conf.get(s, None) for s in settings}
    try:
        for s in settings:
            spark.conf.unset(s)
        assert spark.read.text(text).rdd.getNumPartitions() < 20
        size = sum(f.stat().st_size for f in (tmp_path / "landed").glob("part-*"))
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", size // 40)
        session.spread(spark, text)
        assert spark.read.text(text).rdd.getNumPartitions() >= 40
        assert spark.read.text(text).count() == 4000
        wide = [spark.conf.get(s) for s in settings]
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", size)
        session.spread(spark, text)
        assert [spark.conf.get(s) for s in settings] == wide  # never fewer than the session has
    finally:
        for s, value in before.items():
            spark.conf.unset(s) if value is None else spark.conf.set(s, value)
