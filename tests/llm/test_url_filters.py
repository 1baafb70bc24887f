"""URL filters against plain judgement of every capture and entry."""

from datetime import date

from barloom.llm import url_filters

CAPTURES = "capture_id long, url string, fetched date"
ENTRIES = "pattern string, action string, since date"


def judged(spark, captures, entries):
    found = url_filters.judge(
        spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)
    )
    return {r["capture_id"]: tuple(r)[1:] for r in found.collect()}


def test_captures_after_the_last_entry(spark):
    url = "http://bad.example.com/x"
    entries = [
        ("bad.example.com", "block", date(2024, 3, 15)),
        ("example.com", "allow", date(2023, 1, 1)),
        ("example.com", "lift", date(2026, 5, 20)),
    ]
    days = {
        1: date(2024, 3, 14), 2: date(2024, 3, 15), 3: date(2026, 2, 1), 4: date(2026, 5, 19),
        5: date(2026, 5, 20), 6: date(2031, 12, 31), 7: date(1999, 1, 1), 8: None,
    }
    got = judged(spark, [(i, url, d) for i, d in days.items()], entries)
    block, allow, none = ("bad.example.com", "block", True), ("example.com", "allow", False), (None, None, False)
    assert got == {
        1: (1, *allow), 2: (2, *block), 3: (2, *block), 4: (2, *block), 5: (1, *block),
        6: (1, *block), 7: (0, *none), 8: (0, *none),
    }


def test_deep_paths(spark):
    day = date(2024, 6, 1)
    entries = [
        ("h.org/a/b/c", "block", date(2024, 1, 1)),
        ("h.org/a/b", "allow", date(2024, 1, 1)),
        ("h.org/" + "/".join("s" * 40), "block", date(2024, 1, 1)),
    ]
    urls = {
        1: "http://h.org/a/b/c", 2: "http://www.h.org/a/b/c/d/e?q#f", 3: "http://h.org/a/b/x",
        4: "http://h.org/a", 5: "http://h.org/" + "/".join("s" * 40), 6: "http://h.org",
        7: "http://h.org/" + "/".join("s" * 39), 8: "http://h.org//a//b/c",
    }
    got = judged(spark, [(i, u, day) for i, u in urls.items()], entries)
    deep, none = (2, "h.org/a/b/c", "block", True), (0, None, None, False)
    assert got == {
        1: deep, 2: deep, 3: (1, "h.org/a/b", "allow", False), 4: none,
        5: (1, entries[2][0], "block", True), 6: none, 7: none, 8: deep,
    }


def test_lists_without_paths_and_empty_tables(spark):
    capture, day = (1, "http://h.org/a", date(2024, 6, 1)), date(2024, 1, 1)
    assert judged(spark, [capture], [("h.org", "block", day)]) == {1: (1, "h.org", "block", True)}
    assert judged(spark, [capture], []) == {1: (0, None, None, False)}
    assert judged(spark, [], [("h.org/a", "block", day)]) == {}
