import pytest

from lumenpath.operators import windows
from lumenpath.sources import sinks


def test_bundle_keeps_file_order(spark):
    rows = [("u1", "b.txt", "two", 2), ("u1", "a.txt", "one", 1), ("u2", "c.txt", "three", 1)]
    got = {r.u: r for r in windows.bundle_text(spark.createDataFrame(rows, "u string, f string, t string, n int"), "u", "f", "t", "n").collect()}
    assert got["u1"].bundle == "# UNIT u1\n\n### FILE: a.txt\none\n\n### FILE: b.txt\ntwo"
    assert (got["u1"].n_files, got["u1"].chars, got["u2"].chars) == (2, 6, 5)


def test_page_holds_the_payload_and_refuses_a_large_one(spark, tmp_path):
    c = spark.createDataFrame([("a", "A </script>", ["X"], 1)], "slug string, name string, courses array<string>, degree int")
    ln = spark.createDataFrame([("a", "b", "related")], "src string, dst string, type string")
    occ = spark.createDataFrame([("a", "f", "used", "q" * 500)], "slug string, rel_path string, role string, quote string")
    payload = sinks.graph_payload(c, ln, occ)
    sinks.write_page(payload, str(tmp_path / "p.html"))
    page = (tmp_path / "p.html").read_text()
    assert '"name":"A <\\/script>"' in page and "q" * 400 in page and "q" * 401 not in page and "__DATA__" not in page
    with pytest.raises(ValueError):
        sinks.write_page(payload, str(tmp_path / "q.html"), max_bytes=10)
