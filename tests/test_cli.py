"""The command line, end to end: archives -> lake -> table -> results -> lookups -> replay."""

import os

from test_ingest import csv_text, make_zip, record

from ontime.cli import main
from ontime.config import SELECTED_FIELDS


def test_cli_pipeline(spark, workdir, capsys):
    raw = os.path.join(workdir, "RAW")
    os.makedirs(raw)
    rows = [record(4, origin="CMI", dest="ORD"), record(6, origin="ORD", dest="LAX"),
            record(6, origin="ORD", dest="CMI", carrier="UA", delay="3.00")]
    rows[1]["DepTime"] = "1315"
    make_zip(os.path.join(raw, "m.zip"), {"m.csv": csv_text(rows, SELECTED_FIELDS)})
    lake, table, results = (os.path.join(workdir, d) for d in ("lake", "table", "results"))

    n = ["--no-scale-defaults"]   # keep the test session's 8 shuffle partitions
    main(n + ["ingest", "--source", raw, "--lake", lake, "--work", os.path.join(workdir, "w")])
    main(n + ["load", "--lake", lake, "--table", table])
    main(n + ["batch", "--table", table, "--results", results, "--year", "2008"])
    main(n + ["lookup", "--results", results, "--table-id", "2_4", "--keys", "CMI-ORD,ORD-CMI"])
    main(n + ["lookup", "--results", results, "--table-id", "3_2", "--pairs", "CMI-ORD-LAX@2008-03-04"])
    main(n + ["replay", "--lake", lake, "--topics", "a,b", "--out", os.path.join(workdir, "msgs")])
    out = capsys.readouterr().out
    assert "archives: {'OK': 1}" in out
    assert "flights table" in out and "3 rows" in out
    assert "CMI-ORD,-14.0" in out and "ORD-CMI,3.0" in out
    assert "CMI-ORD-LAX" in out
    assert "a: 2" in out and "b: 1" in out


def test_cluster_defaults_respect_user_settings(spark):
    from ontime.config import CLUSTER_DEFAULTS, cluster_defaults
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = cluster_defaults(spark)
    try:
        # set when the session was built: left alone
        assert "spark.sql.shuffle.partitions" not in applied
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        # not set by the session: the large-cluster value
        assert applied["spark.sql.files.maxPartitionBytes"] == CLUSTER_DEFAULTS["spark.sql.files.maxPartitionBytes"]
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 * 1024 * 1024)
    finally:
        for k in applied:
            spark.conf.unset(k)
