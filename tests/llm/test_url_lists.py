import datetime
import random

from vecquery.llm import url_lists

DAY = datetime.date(2024, 1, 1)
CAPTURES = "page_id bigint, url string, day date, list string, kind string"
ENTRIES = "kind string, value string, list string, day date, action string, days int, url string"


def day(n):
    return DAY + datetime.timedelta(days=n)


def keys(url):
    out = [("url", url)]
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest.split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower()
        path = "/" + rest.split("/", 1)[1].split("/")[0].split("?")[0].split("#")[0] if "/" in rest.split("?")[0].split("#")[0] else ""
        out += [("host", host), ("prefix", host + path)]
        labels = host.split(".")
        out += [("domain", ".".join(labels[-n:])) for n in range(2, len(labels) + 1)]
    return out


def brute(captures, entries):
    out = []
    for page, url, at, *_ in captures:
        found = set()
        for kind, value in keys(url) if url and at else []:
            for name in {e[2] for e in entries}:
                own = [e for e in entries if e[:3] == (kind, value, name) and e[3] <= at]
                taken_off = max((e[3] for e in own if e[4] == "remove"), default=day(-100))
                if any(e[4] == "add" and e[3] > taken_off and (e[5] is None or at < e[3] + datetime.timedelta(days=e[5])) for e in own):
                    found.add(name)
        out.append((page, url, str(at), ",".join(sorted(found)), bool(found) and not any(f.startswith("allow") for f in found)))
    return sorted(out, key=str)


def run(spark, captures, entries):
    got = url_lists.judge(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)).collect()
    assert all(r["n_lists"] == (len(r["lists"].split(",")) if r["lists"] else 0) for r in got)
    return sorted(((r["page_id"], r["url"], str(r["day"]), r["lists"], r["blocked"]) for r in got), key=str)


def test_equals_brute_force(spark):
    draw = random.Random(1)
    urls = [f"{s}://{u}{h}{p}" for s in ("http", "https") for u in ("", "me@") for h in ("a.b.example.com", "b.example.com:80", "Example.com", "other.org") for p in ("", "/", "/x/y?z=1", "/x#t")]
    captures = [(i, draw.choice(urls), day(draw.randrange(30)), "c", "c") for i in range(200)]
    entries = []
    for _ in range(150):
        kind, value = draw.choice(keys(draw.choice(urls)))
        entries.append((kind, value, draw.choice(["spam", "malware", "allow_us"]), day(draw.randrange(-5, 30)), draw.choice(["add", "add", "remove"]), draw.choice([None, 1, 4, 10]), "e"))
    assert run(spark, captures, entries) == brute(captures, entries)


def test_edges(spark):
    captures = [(1, None, day(1), None, None), (2, "http://a.com/", None, None, None), (3, "no host", day(1), None, None), (3, "no host", day(1), None, None), (None, "", day(1), None, None), (5, "http://a.com/" + "x" * 30_000, day(1), None, None)]
    entries = [("host", "a.com", "spam", day(0), "add", None, None), ("host", None, "spam", day(0), "add", None, None), ("host", "a.com", "spam", None, "add", 3, None), ("url", "no host", "spam", day(1), "add", 1, None), ("host", "a.com", "other", day(0), "odd", None, None)]
    got = run(spark, captures, entries)
    assert got == brute(captures, [e for e in entries if e[3] and e[1] and e[4] != "odd"])
    assert run(spark, captures[:0], entries) == []
    assert all(not r[4] for r in run(spark, captures, entries[:0]))


def test_a_later_addition_shortens_none_before_it(spark):
    add = [("host", "a.com", "spam", day(0), "add", None, None), ("host", "a.com", "spam", day(9), "add", 5, None)]
    captures = [(i, "http://a.com/", day(i), None, None) for i in range(60)]
    assert [r[3] for r in sorted(run(spark, captures, add), key=lambda r: r[0])] == ["spam"] * 60
    off = [("host", "a.com", "spam", day(30), "remove", None, None), ("host", "a.com", "spam", day(40), "add", 3, None), ("host", "a.com", "spam", day(41), "add", 1, None)]
    assert [bool(r[3]) for r in sorted(run(spark, captures, add + off), key=lambda r: r[0])] == [i < 30 or 40 <= i < 43 for i in range(60)]
    rows = url_lists.intervals(spark.createDataFrame(add + off, ENTRIES)).collect()
    assert {(str(r["valid_from"]), str(r["valid_to"])) for r in rows} == {(str(day(0)), str(day(30))), (str(day(40)), str(day(43)))}


def test_main_path_has_no_python(spark):
    plan = url_lists.judge(spark.createDataFrame([], CAPTURES), spark.createDataFrame([], ENTRIES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
