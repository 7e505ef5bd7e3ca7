import random

import pytest

from tidemark.llm import warc

PAGES = "page_id long, url string, html string, refers_to string, offset string"


def test_loser_tree_merges_any_runs():
    rng = random.Random(1)
    for k in range(30):
        runs = [sorted((rng.randint(0, 20),) for _ in range(rng.randint(0, 8))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_round_trip_and_global_order(spark):
    rng = random.Random(2)
    html = ["", "<p>é</p>", "a\r\n\r\nWARC/1.1\r\n\r\n", "x" * 300_000, None]
    rows = [(i, f"http://h{rng.randint(0, 5)}.example.com/p{rng.randint(0, 3)}", rng.choice(html), "c", "c") for i in range(80)]
    rows += [(500, None, "lonely", "c", "c"), (501, "bad url\nwith lines", "q", "c", "c"), (None, "http://x/", "<p>é</p>", "c", "c")]
    rows += [rows[3]]
    pages = spark.createDataFrame(rows, PAGES).repartition(6)
    got = warc.capture_history(pages).collect()
    assert len(got) == len(rows)
    order = [(r["url_key"], r["captured_at"], str(r["page_id"] if r["page_id"] is not None else "")) for r in got]
    assert order == sorted(order)
    first = {}
    for i, _, h, *_ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    text = {i: h or "" for i, _, h, *_ in rows}
    for r in got:
        payload = text[r["page_id"]].encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), warc.digest(payload))
        lead = first[text[r["page_id"]]]
        kind = ("response", None) if lead == r["page_id"] else ("revisit", lead)
        assert (r["record_type"], r["refers_to"]) == kind


def test_small_payloads_stay_responses_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a/", "xy", "", ""), (2, "http://a/", "xy", "", "")], PAGES)
    assert {r["record_type"] for r in warc.capture_history(pages, min_bytes=3).collect()} == {"response"}
    assert warc.capture_history(pages.limit(0)).count() == 0


def test_damaged_archives_are_refused():
    raw = warc.record("1", "http://a/", b"payload", None)
    with pytest.raises(ValueError):
        warc.capture("run", 0, raw.replace(b"payload", b"pAyload"))
    with pytest.raises(ValueError):
        warc.parse(raw[:-8])
    assert warc.parse(raw)[0]["WARC-Type"] == "response"
