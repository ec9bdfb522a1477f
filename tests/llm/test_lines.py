"""Site-relative line frequencies against a plain count."""

from collections import Counter, defaultdict

import pytest

from musterroll.llm import lines


def page(*parts):
    return "<html><head><title>t</title><style>p{}</style></head><body>" + "".join(f"<p>{p}</p>" for p in parts) + "</body></html>"


def brute(rows, ratio, least):
    pages, counts = Counter(), defaultdict(Counter)
    for _, host, own in rows:
        pages[host] += 1
        counts[host].update(set(own))
    return sorted(
        (i, h, len(own), "\n".join(x for x in own if pages[h] < least or counts[h][x] <= ratio * pages[h])) for i, h, own in rows
    )


def test_counts(spark):
    rows = []
    for i in range(60):
        host = ["a.example.org", "b.example.org", "few.example.org"][0 if i % 3 else 1 + (i > 50)]
        own = ["menu", f"own {i}", "twice", "twice"] + (["half"] if i % 2 else []) + (["rare"] if i % 11 == 0 else [])
        rows.append((i, host, own))
    frame = spark.createDataFrame(
        [(i, f"HTTP://me@{h.upper()}:80/x?{i}", page(*own), "c", "c") for i, h, own in rows],
        "page_id long, url string, html string, lines string, kept string",
    )
    got = lines.drop_site_lines(frame).collect()
    rows = [(i, h, ["t", *own]) for i, h, own in rows]
    want = brute(rows, lines.RATIO, lines.LEAST_PAGES)
    assert sorted((r["id"], r["host"], r["n_lines"], r["kept"]) for r in got) == want
    assert all(r["n_dropped"] == r["n_lines"] - (r["kept"].count("\n") + 1 if r["kept"] else 0) for r in got)


def test_edges(spark):
    rows = [(1, None, None), (2, "no url", ""), (None, "http://x/", page("a")), (3, "http://x/", "plain\r\ntext\n\n"), (3, "http://x/", "plain\r\ntext\n\n"),
            (4, "http://x/", page("w " * 50_000)), (5, "http://x/", "<script>no</script><!-- no -->yes <b>bold</b>&amp;")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {str(r["id"]): r for r in lines.drop_site_lines(frame, least_pages=100).collect()}
    assert got["1"]["n_lines"] == got["2"]["n_lines"] == 0 and got["1"]["host"] == "" and got["1"]["kept"] == ""
    assert got["3"]["kept"] == "plain\ntext" and got["5"]["kept"] == "yes bold&amp;" and got["4"]["n_lines"] == 2
    assert lines.drop_site_lines(frame).count() == 7
    assert lines.drop_site_lines(frame.where("false")).collect() == []


@pytest.mark.parametrize("ratio", [0.0, 1.0])
def test_ratio_bounds(spark, ratio):
    frame = spark.createDataFrame([(i, "http://x/", page("same", f"own {i}")) for i in range(8)], "page_id long, url string, html string")
    dropped = {r["n_dropped"] for r in lines.drop_site_lines(frame, ratio=ratio).collect()}
    assert dropped == ({3} if ratio == 0 else {0})
