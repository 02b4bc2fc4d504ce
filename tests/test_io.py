import gzip
import hashlib
import io
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from swident import cli
from swident.operators import curation, extract, vulns
from swident.sources import files, rest, sinks
from swident.streaming.resume import resumable_run
from swident.streaming.windows import tumbling_counts

TOTAL = [(f"cpe:2.3:a:w{i}:p:1:*:*:*:*:*:*:*", i % 2 == 0) for i in range(5)]


def fetch(start, size):
    rows = TOTAL[start : start + size]
    return {"totalResults": len(TOTAL), "resultsPerPage": len(rows) or size, "products": [{"cpe": {"cpeName": n, "titles": [{"title": "de", "lang": "de"}, {"title": n[10:12], "lang": "en"}], "deprecated": d}} for n, d in rows]}


def test_titles_and_export(spark, tmp_path):
    (tmp_path / "t.csv").write_text('title,annotated\n"b ""x"" 1",[b](cpe_vendor)\n\na 2\n')
    assert [(r.title, r.annotated) for r in files.read_titles(spark, str(tmp_path / "t.csv")).orderBy("pos").collect()] == [('b "x" 1', "[b](cpe_vendor)"), ("a 2", None)]
    (tmp_path / "e.csv").write_bytes(b"\xef\xbb\xbfA;B\r\n1;2\r\n3;4\r\n")
    assert [(r.A, r.B, r.pos) for r in files.read_export(spark, str(tmp_path / "e.csv"), ["A"], ";").orderBy("pos").collect()] == [("1", "2", 0), ("3", "4", 1)]
    with pytest.raises(ValueError, match="missing"):
        files.read_export(spark, str(tmp_path / "e.csv"), ["C"], ";")


def test_catalog_widths(spark, tmp_path):
    head = [*curation.REQUIRED, "Override Title"]
    rows = [head, ["x"] * 9, ["x"] * 8, ["x"] * 10, [*["x"] * 8, ""]]
    (tmp_path / "c.csv").write_text("".join(";".join(r) + "\r\n" for r in rows))
    got = files.read_catalog(spark, str(tmp_path / "c.csv"), curation.REQUIRED).orderBy("line").collect()
    assert [(r.line, r.malformed) for r in got] == [(2, False), (3, True), (4, True), (5, False)]


def test_snapshot_replay_packages(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text("\n".join(json.dumps({"cpeName": n, "deprecated": d}) for n, d in TOTAL))
    assert [r.ord for r in files.read_snapshot(spark, str(tmp_path / "s.jsonl")).orderBy("ord").collect()] == [0, 1, 2, 3, 4]
    (tmp_path / "r.json").write_text(json.dumps({"a b": {"vendor": "A", "product": 3}}))
    got = extract.replay(spark.createDataFrame([("a b",), ("c",)], "title string"), files.read_replay(spark, str(tmp_path / "r.json")))
    assert {r.title: (r.vendor, r.product) for r in got.collect()} == {"a b": ("a", None), "c": (None, None)}
    (tmp_path / "d.txt").write_text("openssl:amd64\t3.0.2\tUbuntu\nbad\n")
    assert [(r.name, r.version, r.vendor) for r in files.read_packages(spark, str(tmp_path / "d.txt"), "dpkg").collect()] == [("openssl", "3.0.2", "Ubuntu")]
    assert files.registry_items(spark).count() >= 0


def test_paged_source(spark):
    assert [len(p["products"]) for _, p in rest.pages(fetch, 2)] == [2, 2, 1]
    assert [s for s, _ in rest.pages(fetch, 2, most=2)] == [0]
    assert list(rest.pages(lambda s, n: None, 2)) == []
    assert len(list(rest.pages(lambda s, n: {"totalResults": 9, "products": []}, 2))) == 1
    reader = rest.DictionarySource({"fetch": "test_io.fetch", "pagesize": "2"}).reader(None)
    rows = list(reader.read(reader.partitions()[0]))
    assert [r[4] for r in rows] == [0, 1, 2, 3, 4] and rows[0][2:4] == ("w0", True)
    stream = rest.DictionarySource({"fetch": "test_io.fetch", "pagesize": "3"}).simpleStreamReader(None)
    at, seen = stream.initialOffset(), []
    while True:
        batch, end = stream.read(at)
        got = list(batch)
        if not got:
            break
        assert list(stream.readBetweenOffsets(at, end)) == got
        at, seen = end, seen + got
    assert [r[4] for r in seen] == [0, 1, 2, 3, 4]
    page = rest.graph_page([{"cpeName": "x", "vendor": "v", "product": "p", "version": "*"}], 1)
    assert list(rest.products(page)) == [("x", "", "v p", False)]


def test_graph_pages():
    rows, sent = [[f"n{i}", f"id{i}", i == 1, "v", "*", str(i)] for i in range(5)], []

    def post(statement, parameters):
        sent.append(statement)
        if "count" in statement:
            return {"results": [{"data": [{"row": [5]}]}]}
        return {"results": [{"data": [{"row": r} for r in rows[parameters["skip"] : parameters["skip"] + parameters["limit"]]]}]}

    got = [(start, list(rest.products(page))) for start, page in rest.pages(rest.graph_fetch(post), 2)]
    assert [s for s, _ in got] == [0, 2, 4] and sum("count" in x for x in sent) == 1 and all("ORDER BY" in x for x in sent[1:])
    assert [p for _, ps in got for p in ps][1] == ("n1", "id1", "v 1", True)


def test_pace():
    now, waits = [0.0], []
    call = rest.paced(lambda x: x, 6.5, clock=lambda: now[0], sleep=waits.append)
    assert [call(1), call(2)] == [1, 2] and waits == [6.5]
    now[0] = 5.0
    call(3)
    assert waits == [6.5, 1.5] and (rest.default_pause(""), rest.default_pause("k")) == (6.5, 0.7)


PAGES = """
import json, os
def fetch(start, size):
    with open(os.path.join(os.path.dirname(__file__), "asked"), "a") as f:
        f.write(f"{start}\\n")
    if os.path.exists(os.path.join(os.path.dirname(__file__), f"down{start}")):
        raise OSError("down")
    n = max(0, min(size, 7 - start))
    return {"totalResults": 7, "resultsPerPage": n, "products": [{"cpe": {"cpeName": f"cpe:2.3:a:v{i}:p:1:*:*:*:*:*:*:*" if i else "odd", "titles": [], "deprecated": False}} for i in range(start, start + n)]}
"""


def test_dictionary_build_goes_on_after_a_stop(tmp_path):
    """A process of its own, whose workers can import the service."""
    (tmp_path / "service.py").write_text(PAGES)
    (tmp_path / "down4").write_text("")
    code = f"from pyspark.sql import SparkSession; from swident import cli; s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate(); cli.main(['dict', '--build', r'{tmp_path}/out', '--fetch', 'service.fetch', '--pagesize', '2'], s)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = lambda: subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": f"{root}:{tmp_path}"}, capture_output=True, text=True, check=False)
    assert run().returncode != 0
    (tmp_path / "down4").unlink()
    before = (tmp_path / "asked").read_text().split()
    again = run()
    assert again.returncode == 0, again.stderr[-2000:]
    later = (tmp_path / "asked").read_text().split()[len(before) :]
    assert "0" in before and "0" not in later and "6" in later
    rows = [json.loads(line) for f in (tmp_path / "out").glob("*.gz") for line in gzip.open(f, "rt")]
    assert sorted(r["ord"] for r in rows) == list(range(7))
    assert json.loads((tmp_path / "out.meta.json").read_text())["snapshot"] == {"fetched": 7, "invalid": 1}


def test_back_off(monkeypatch):
    calls, waits = [], []

    def answer(request, timeout):
        calls.append(1)
        raise rest.urllib.error.HTTPError("u", 403 if len(calls) < 3 else 404, "", {}, None)

    monkeypatch.setattr(rest.urllib.request, "urlopen", answer)
    assert rest.http_json("http://x", {}, {}, sleep=waits.append) is None
    assert waits == [30.0, 60.0]


def test_remote_answers_degrade(spark):
    def ask(system, user):
        if user == "bad":
            raise OSError("down")
        return '{"vendor": "V"}', 3, 2

    def fields(system, user):
        return ("null" if "version" in system else f"'{system.split()[3]}'"), 1, 1

    def wait(seconds):
        assert seconds in (1.0, 2.0)

    two = spark.createDataFrame([("ok",), ("bad",)], "title string")
    got = extract.entities_of(extract.remote_answers(two, ask, wait=wait))
    r = {x.title: x for x in got.collect()}
    assert (r["ok"].vendor, r["ok"].tokens_in, r["ok"].error) == ("v", 3, None) and r["bad"].error == "provider failed: OSError: down"
    one = spark.createDataFrame([(1, "x"), (2, "x")], "pos long, title string")
    each = extract.extracted(one, "openai", "per-field", ask=fields).collect()
    assert len(each) == 2 and (each[0].vendor, each[0].version, each[0].confidence, each[0].tokens_out) == ("vendor", None, 0.0, 5)
    plain = extract.extracted(one.withColumn("title", F.lit("acme tool 1.0 beta2 for linux")), "positional", "per-field").first()
    assert (plain.vendor, plain.product, plain.version, plain.update, plain.target_sw, plain.confidence, plain.error) == ("acme", "tool", "1.0", "beta2", "linux", 0.5, None)
    with pytest.raises(ValueError, match="provider"):
        extract.extracted(one, "nobody")


def test_clients(monkeypatch):
    """Bodies and answers of the three remote services; refused extras are dropped for good."""
    sent = []

    def answer(request, timeout):
        body = json.loads(request.data)
        sent.append((request.full_url, body))
        if "reasoning" in body:
            raise extract.urllib.error.HTTPError("u", 400, "", {}, None)
        if "input" in body:
            d = {"output": [{"type": "thought"}, {"type": "message", "content": [{"text": "a"}, {"text": "b"}]}], "stats": {"input_tokens": 4, "total_output_tokens": 2}}
        elif "system" in body:
            d = {"content": [{"text": "m"}], "usage": {"input_tokens": 5, "output_tokens": 1}}
        else:
            d = {"choices": [{"message": {"content": "c"}}], "usage": {"prompt_tokens": 6, "completion_tokens": 3}}
        return io.BytesIO(json.dumps(d).encode())

    monkeypatch.setattr(extract.urllib.request, "urlopen", answer)
    local = extract.local_server("http://l", "m")
    assert local("s", "u") == local("s", "u") == ("ab", 4, 2) and ["reasoning" in b for _, b in sent] == [True, False, False]
    assert extract.messages_api("http://m", "m", "k")("s", "u") == ("m", 5, 1)
    assert extract.chat_completion("http://c", "m", "k", {"reasoning": "off"})("s", "u") == ("c", 6, 3)


def test_resume_writes_no_title_twice(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "check"))
    put = lambda names: spark.createDataFrame([(n,) for n in names], "title string").write.mode("append").parquet(src)
    schema = spark.createDataFrame([], "title string").schema
    go = lambda: resumable_run(spark, src, schema, lambda df: df.withColumn("n", F.length("title")), out, mark).awaitTermination()
    put(["a", "bb", "a"])
    go()
    put(["bb", "ccc"])
    go()
    assert sorted(r.title for r in spark.read.parquet(out).collect()) == ["a", "bb", "ccc"]


def test_streaming_windows_equal_batch(spark, tmp_path):
    rows = [(f"2024-01-01 0{i % 5}:10:00", "a", 1.0) for i in range(10)] + [("2024-01-02 00:00:00", "a", 1.0)]
    df = spark.createDataFrame(rows, "t string, event_type string, value double").selectExpr("timestamp(t) ts", "event_type", "value")
    df.write.parquet(str(tmp_path / "e"))
    stream = tumbling_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "e")), "1 hour", late="10 minutes")
    q = stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, tumbling_counts(df, "1 hour").collect()))


def test_cli(spark, tmp_path, capsys):
    good = TOTAL[0][0]
    assert cli.main(["validate", good], spark) == 0
    assert cli.main(["validate", good, "cpe:2.3:a"], spark) == 1
    (tmp_path / "t.csv").write_text("w0 p 1,[w0](cpe_vendor) [p](cpe_product) [1](cpe_version)\nzz yy 9\n")
    (tmp_path / "s.jsonl").write_text("\n".join(json.dumps({"cpeName": n, "deprecated": False}) for n, _ in TOTAL))
    assert cli.main(["run", str(tmp_path / "t.csv"), "--dictionary", str(tmp_path / "s.jsonl"), "--out", str(tmp_path / "out")], spark) == 0
    assert {r.title: r.rule for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"w0 p 1": "M1", "zz yy 9": "M4"}
    assert "1 titles, 1 exact" in capsys.readouterr().out
    (tmp_path / "r.json").write_text(json.dumps({"zz yy 9": {"vendor": "w1", "product": "p", "version": "1"}, "w0 p 1": {}}))
    assert cli.main(["run", str(tmp_path / "t.csv"), "--dictionary", str(tmp_path / "s.jsonl"), "--out", str(tmp_path / "again"), "--provider", "replay", "--answers", str(tmp_path / "r.json")], spark) == 0
    got = {r.title: (r.rule, r.error) for r in spark.read.parquet(str(tmp_path / "again")).collect()}
    assert got == {"zz yy 9": ("M1", None), "w0 p 1": (None, "no vendor/product extracted")}
    assert cli.main(["agent", str(tmp_path / "t.csv"), "--dictionary", str(tmp_path / "s.jsonl"), "--out", str(tmp_path / "agent")], spark) == 0
    assert {r.title: (r.stage, r.rule, r.fast_rule) for r in spark.read.parquet(str(tmp_path / "agent")).collect()} == {"w0 p 1": ("fast", "M1", None), "zz yy 9": ("agent", "M4", "M4")}
    capsys.readouterr()
    for _ in range(2):  # finished combinations are not run again
        assert cli.main(["bench", str(tmp_path / "t.csv"), "--dictionary", str(tmp_path / "s.jsonl"), "--models", "A b", "--out", str(tmp_path / "bench")], spark) == 0
    assert "| 1 | A b | per-field | 1.000 | 1.000 | 1.000 |" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(str(tmp_path / "bench" / "bench_summary")).count() == 2
    sinks.write_csv(spark.read.parquet(str(tmp_path / "out")).drop("pos"), str(tmp_path / "fast"))
    assert cli.main(["escalate", str(tmp_path / "fast"), "--dictionary", str(tmp_path / "s.jsonl"), "--provider", "replay", "--answers", str(tmp_path / "r.json"), "--model", "big", "--out", str(tmp_path / "esc")], spark) == 0
    merged = {r.title: (r.rule, r.fast_rule, r.escalated_by) for r in spark.read.option("header", True).csv(str(tmp_path / "esc" / "results_merged")).collect()}
    assert merged["zz yy 9"] == ("M1", "M4", "big") and merged["w0 p 1"][0] == "M1"
    assert json.loads((tmp_path / "esc" / "metrics.json").read_text())["stats"]["transitions"] == {"M4 -> M1": 1}
    assert spark.read.csv(str(tmp_path / "esc" / "escalate_titles")).first()[0] == "zz yy 9"
    assert cli.main(["dict", str(tmp_path / "s.jsonl")], spark) == 0
    assert "'entries': 5" in capsys.readouterr().out
    (tmp_path / "d.txt").write_text("openssl:amd64\t3.0.2\tUbuntu\n")
    assert cli.main(["inventory", "--path", str(tmp_path / "d.txt"), "--out", str(tmp_path / "inv")], spark) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "inv")).first().title == "openssl 3.0.2"
    sinks.write_csv(spark.createDataFrame([(["a", "b"], True)], "x array<string>, y boolean"), str(tmp_path / "w"))
    assert tuple(spark.read.option("header", True).csv(str(tmp_path / "w")).first()) == ("a,b", "1")


def test_cli_catalog_to_splits(spark, tmp_path, capsys):
    head = [*curation.REQUIRED, "Override Title"]
    name = "cpe:2.3:a:v{}:p:1:*:*:*:*:*:*:*"
    rows = [{"CPE": name.format(i), "Title": f"t{i}", "Vuln DB ID": f"k{i}", "Created By": "x"} for i in range(20)] + [{"CPE": "", "Title": "none"}]
    (tmp_path / "c.csv").write_text(";".join(head) + "\n" + "".join(";".join(r.get(h, "") for h in head) + "\n" for r in rows))
    assert cli.main(["curate", str(tmp_path / "c.csv"), "--out", str(tmp_path / "cur")], spark) == 0
    m = json.loads((tmp_path / "cur" / "metrics.json").read_text())
    assert m["stats"]["rows_kept"] == 20 and m["outputs"] and list(m["sources"].values()) == [hashlib.sha256((tmp_path / "c.csv").read_bytes()).hexdigest()]
    assert cli.main(["tier", str(tmp_path / "cur" / "catalog"), "--out", str(tmp_path / "tier")], spark) == 0
    assert json.loads((tmp_path / "tier" / "metrics.json").read_text())["stats"]["routes"] == {"B": 20}
    assert cli.main(["split", str(tmp_path / "tier" / "routes"), "--out", str(tmp_path / "split")], spark) == 0
    s = json.loads((tmp_path / "split" / "split_metrics.json").read_text())
    assert s["rows"] == 20 and s["counts"]["train"]["families"] == 16 and s["sources"]
    assert "| train | 16 | 16 |" in (tmp_path / "split" / "MANIFEST.md").read_text()
    (tmp_path / "e.csv").write_text("name,v\nTool A,1\ntool a,1\n-,\n")
    assert cli.main(["titles", str(tmp_path / "e.csv"), "--columns", "name", "--version", "v", "--out", str(tmp_path / "t")], spark) == 0
    assert json.loads((tmp_path / "t.metrics.json").read_text())["stats"] == {"rows_read": 3, "garbage": 1, "too_short": 0, "noise": 0, "duplicates": 1, "written": 1}


def test_vulnerabilities_online(spark, tmp_path):
    """Names that the cache lacks are asked for, page by page; failures are the names' errors."""
    names = [TOTAL[i][0] for i in range(3)]

    def fetch_of(cpe):
        def get(start, size):
            if "w1" in cpe:
                raise OSError("down")
            return {"totalResults": 3, "resultsPerPage": min(size, 3 - start), "vulnerabilities": [{"cve": {"id": f"CVE-{i}"}} for i in range(start, min(3, start + size))]}

        return get

    got = {r.cpe: r for r in rest.cve_items(spark.createDataFrame([(n,) for n in [*names, names[0]]], "cpe string"), fetch_of, size=2).collect()}
    assert [c["id"] for c in json.loads(got[names[0]].payload)] == ["CVE-0", "CVE-1", "CVE-2"] and got[names[1]].error == "api error: down"
    results = spark.createDataFrame([(n, n, "M1", "") for n in names], "title string, cpe string, rule string, matched_cpe string")
    known = spark.createDataFrame([(names[2], "[]", None)], "cpe string, payload string, error string")
    assert sorted(r.cpe for r in vulns.wanted(results, known).collect()) == names[:2]
    all_ = known.unionByName(rest.cve_items(vulns.wanted(results, known), fetch_of)).select("cpe", F.from_json("payload", f"array<{vulns.ITEM}>").alias("items"), "error")
    out = {r.title: (r.vulnerable, r.error) for r in vulns.check(results, all_).collect()}
    assert out == {names[0]: (True, None), names[1]: (False, "api error: down"), names[2]: (False, None)}
    path = str(tmp_path / "cache")
    assert files.read_cache(spark, path).isEmpty()
    for payload in ("[1]", "[2]"):  # a cache is replaced whole
        sinks.write_cache(files.read_cache(spark, path).unionByName(spark.createDataFrame([("q" + payload, payload)], "query string, payload string")), path)
    assert sorted(map(tuple, files.read_cache(spark, path).collect())) == [("q[1]", "[1]"), ("q[2]", "[2]")]
    assert [p.name for p in tmp_path.iterdir()] == ["cache"]
