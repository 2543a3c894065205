"""Tool calls, shards, path templates and the pipeline."""

import json
import math
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCS, PROSE, awkward, documents  # noqa: E402

import corpus_pipeline  # noqa: E402
from tillhouse.llm import queries, sharding, tool_calls, url_templates  # noqa: E402
from tillhouse.llm.url_templates import Rule  # noqa: E402

CALLS = (
    "conv_id bigint, call_id string, turn bigint, tool string, arguments string, "
    "after array<string>"
)
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"


# --- tool calls --------------------------------------------------------------------


def log(spark, calls, results, schemas=queries.SCHEMAS):
    frames = (spark.createDataFrame(*x) for x in
              ((calls, CALLS), (results, RESULTS), (schemas, queries.SCHEMA_COLUMNS)))
    return tool_calls.tool_log(*frames)


def test_links_levels_and_errors(spark):
    calls = [
        (1, "a", 1, "search", '{"limit": 3, "query": "x"}', []),
        (1, "b", 3, "search", '{"query": 5}', ["a"]),
        (1, "c", 5, "lookup", '{"id": "x", "more": {"b": 1, "a": [1, 2]}}', ["b", "a", "zz"]),
        (1, "d", 6, "nothing", "{}", ["e"]), (1, "e", 7, "count", "[1]", ["d"]),
        (1, "f", 8, "count", "oops", ["e"]), (1, "a", 9, "count", '{"query": "again"}', None),
        (2, "a", 1, None, None, None), (None, "n", 1, "count", '{"query": "q"}', ["m"]),
        (1, None, 2, "count", '{"query": "q"}', None), (3, "late", 5, "count", '{"query":"é"}', []),
    ]
    results = [
        (1, "a", 2, '{"z": 1,  "y": null}'), (1, "a", 10, "second"), (1, "q", 4, "orphan"),
        (3, "late", 1, "early"), (1, None, 3, "nameless"), (2, "a", 2, None),
    ]
    rows = log(spark, calls, results).collect()
    assert len(rows) == len(calls) + 2
    by = {(r.conv_id, r.call_id, r.nth): r for r in rows if r.status != "orphan"}
    assert by[1, "a", 1].status == by[1, "a", 2].status == "linked"
    assert json.loads(by[1, "a", 1].record)["result"] == {"y": None, "z": 1}
    assert by[1, "a", 1].record == (
        '{"arguments":{"limit":3,"query":"x"},"call_id":"a","result":{"y":null,"z":1},'
        '"tool":"search"}'
    )
    assert json.loads(by[1, "a", 2].record)["result"] == "second"
    assert by[3, "late", 1].status == "early" and by[1, "b", 1].status == "unanswered"
    assert [by[1, k, 1].level for k in "abcdef"] == [0, 1, 2, None, None, None]
    assert by[1, "a", 1].errors == []
    assert by[1, "b", 1].errors == ["limit missing", "query not string"]
    assert by[1, "c", 1].errors == ["id not integer", "more unexpected"]
    assert by[1, "d", 1].errors == ["unknown tool"] and by[1, "e", 1].errors == ["not an object"]
    assert by[1, "f", 1].errors == ["not an object"]
    assert sorted(r.call_id or "" for r in rows if r.status == "orphan") == ["", "q"]
    assert log(spark, [], []).count() == 0


def canonical(text):
    if text is None:
        return None
    try:
        return json.loads(text)
    except ValueError:
        return text


def faults(schema, value, path=""):
    """Errors of a value by walking down; ``schema`` from paths to (kind, required, ...)."""
    below = f"{path}/" if path else ""
    known = {p[len(below):]: v for p, v in schema.items()
             if p.startswith(below) and "/" not in p[len(below):]}
    if isinstance(value, dict) and known:
        inner = {k.replace("~", "~0").replace("/", "~1"): v for k, v in value.items()}
        wrong = {f"{below}{k} missing" for k, v in known.items() if v[1] and k not in inner}
    elif isinstance(value, list) and known:
        inner, wrong = {}, set()
        for item in value:
            wrong |= fault(schema, item, f"{below}[]")
    else:
        return set()
    return wrong.union(*(fault(schema, v, below + k) for k, v in inner.items()))


def fault(schema, value, path):
    kinds = {"integer": (int,), "number": (int, float), "string": (str,), "boolean": (bool,),
             "array": (list,), "object": (dict,), None: (object,)}
    inner = faults(schema, value, path)
    if path not in schema:
        return {f"{path} unexpected"} | inner
    kind, _, choices, least, most = schema[path]
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if not isinstance(value, kinds[kind]) or (isinstance(value, bool) and kind in ("integer", "number")):
        return {f"{path} not {kind}"} | inner
    if choices is not None and json.dumps(value, separators=(",", ":")) not in choices:
        return {f"{path} not a choice"} | inner
    if number and least is not None and value < least:
        return {f"{path} too small"} | inner
    if number and most is not None and value > most:
        return {f"{path} too large"} | inner
    return inner


def test_nested_arguments_by_walking_down(spark):
    schema = [
        ("t", "a", "object", True, None, None, None), ("t", "a/n", "number", True, None, -1.5, 3.0),
        ("t", "a/x~1y", "string", False, ['"p"', '"q"'], None, None),
        ("t", "l", "array", False, None, None, None), ("t", "l/[]", "object", False, None, None, None),
        ("t", "l/[]/k", "integer", True, None, 0.0, None), ("t", "l/[]/m", "array", False, None, None, None),
        ("t", "l/[]/m/[]", "boolean", False, None, None, None), ("t", "any", None, False, None, None, None),
    ]
    given = [
        '{"a":{"n":1}}', '{"a":{"n":-1.5,"x/y":"p"},"any":{"z":[1,{"u":2}]}}', '{"a":{"n":3.5}}', "{}",
        '{"a":[1]}', '{"a":{"x/y":"r","w":1}}', '{"a":{"n":"1"},"l":[]}', '{"a":null,"l":[{"k":1},{"k":-1}]}',
        '{"a":{"n":-2},"l":[{},{},3,{"k":1.5,"m":[true,false]},{"k":2,"m":[1]}]}', '{"b":1,"l":{"k":1}}',
        '{"a":{"n":true},"any":null}', '{"a":{"n":2,"x/y":null},"l":[{"k":0,"m":{}}],"c":{"d":1}}',
    ]
    calls = [(1, f"c{i}", i, "t", g, None) for i, g in enumerate(given)]
    by_path = {row[1]: row[2:] for row in schema}
    rows = {r.call_turn: r.errors for r in log(spark, calls, [], schema).collect()}
    for i, text in enumerate(given):
        assert rows[i] == sorted(faults(by_path, json.loads(text))), text
    assert {tuple(e) for e in (r.errors for r in log(spark, calls, [], []).collect())} == {("unknown tool",)}


def test_levels_against_walks(spark):
    random = np.random.default_rng(11)
    waits = {}
    for conv in range(6):
        for i in range(60):
            few = random.choice([0, 1, 1, 1, 1, 2, 3])
            waits[conv, f"k{i}"] = {f"k{j}" for j in random.integers(max(0, i - 4), i, few)} if i else set()
        if conv % 2:  # a cycle, and calls behind it
            waits[conv, "k20"] = {"k22"}
            waits[conv, "k21"], waits[conv, "k22"] = {"k20"}, {"k21", "gone"}
    for i in range(300):
        waits[9, f"k{i}"] = {f"k{i - 1}"} if i else set()
    calls = [(c, k, 1, "count", None, sorted(w)) for (c, k), w in waits.items()]
    found = {(r.conv_id, r.call_id): r.level for r in log(spark, calls, []).collect()}
    placed, left = {}, dict(waits)
    while True:
        ready = {key: 1 + max((placed[key[0], w] for w in ws if (key[0], w) in waits), default=-1)
                 for key, ws in left.items()
                 if all((key[0], w) in placed for w in ws if (key[0], w) in waits)}
        if not ready:
            break
        placed.update(ready)
        left = {key: ws for key, ws in left.items() if key not in placed}
    assert left and max(placed.values()) == 299
    assert found == {key: placed.get(key) for key in waits}


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    calls, results = (x.collect() for x in queries.messages(turns))
    rows = queries.op8_tool_calls(spark, folder).collect()
    answers = {(r.conv_id, r.call_id): r for r in results}
    expected = {(c.conv_id, c.call_id): c for c in calls}
    assert len(rows) == len(calls) + sum(k not in expected for k in answers)

    def level(key):
        waits = [(key[0], a) for a in expected[key].after if (key[0], a) in expected]
        return 1 + max(map(level, waits)) if waits else 0

    for r in rows:
        key = (r.conv_id, r.call_id)
        if r.status == "orphan":
            assert key not in expected and key in answers
            continue
        call = expected[key]
        assert (r.status == "linked") == (key in answers)
        assert r.level == level(key)
        given = canonical(call.arguments)
        schema = {row[1]: row[2:] for row in queries.SCHEMAS if row[0] == call.tool}
        wrong = faults(schema, given) if isinstance(given, dict) else {"not an object"}
        assert r.errors == ", ".join(sorted(wrong))
        record = {"arguments": given, "call_id": r.call_id, "tool": call.tool,
                  "result": canonical(answers[key].content) if key in answers else None}
        assert json.loads(r.record) == record
        assert r.record == json.dumps(
            record, sort_keys=True, separators=(",", ":"), ensure_ascii=False
        )


# --- shards ------------------------------------------------------------------------


def test_fisher_yates_is_uniform():
    random = np.random.default_rng(1)
    seen = Counter(tuple(sharding.fisher_yates(3, random)) for _ in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert sharding.fisher_yates(0, random).tolist() == []


def test_query_keeps_the_law(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op9_shards(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append((r.slot, r.doc_id))
    for found in slots.values():
        assert sorted(s for s, _ in found) == list(range(len(found)))
    assert 5 <= sum(r.grown_shard == 40 for r in rows) <= 60
    ordered = [i for _, found in sorted(slots.items()) for _, i in sorted(found)]
    climbs = sum(a < b for a, b in zip(ordered, ordered[1:], strict=False))
    assert 0.4 < climbs / len(ordered) < 0.6


def test_shards_of_awkward_rows_and_small_buckets(spark):
    docs = awkward(spark)
    for size in (100, 10**7):
        folder = sharding.write_shards(docs, shards=3, bucket_bytes=size)
        rows = sharding.read_shards(spark, folder, docs).collect()
        assert sorted(map(repr, (r.record for r in rows))) == sorted(map(repr, docs.collect()))
        by_shard = defaultdict(list)
        for r in rows:
            by_shard[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    empty = spark.createDataFrame([], DOCS)
    assert sharding.read_shards(spark, sharding.write_shards(empty), empty).count() == 0


def test_one_id_is_split_into_buckets(spark):
    docs = documents(spark, [(1, PROSE)] * 300)
    folder = sharding.write_shards(docs, shards=2, bucket_bytes=2000)
    rows = sharding.read_shards(spark, folder, docs)
    assert rows.select("shard").distinct().count() == 1
    assert spark.read.parquet(folder).select("bucket").distinct().count() > 5


# --- path templates ----------------------------------------------------------------


def test_host_path_and_rules(spark):
    urls = [
        "http://www.Example.ORG/es/1?x#y", "https://example.org/en/17", "https://a.example.org/en/27",
        "x://nexample.org/es/", "http://b.com/fr/", "http://com/de/x", "http://b.com/de", "b.com/fr/1",
        None, "http://", "a://b://c/d", "http://x.org", "http://x.org?u=/es/", "HTTP://É.COM/fr/a\nb?",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = {r.page_id: r for r in url_templates.filtered(pages, queries.RULES).collect()}
    expected = []
    for url in urls:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
            host, rest = rest[:cut], rest[cut:]
            path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fitting = [r for r in queries.RULES
                   if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        expected.append((host, path, max(fitting, key=lambda r: len(r.text), default=None)))
    for i, (host, path, rule) in enumerate(expected):
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule and rule.text)
        if rule:
            assert rows[i].verdict == rule.verdict


def test_bad_templates_go_and_others_stay(spark):
    rules = [Rule("block", "bad.net", "/spam/a"), Rule("allow", "bad.net", "/news/a")]
    urls = [f"http://bad.net/spam/a{chr(97 + i % 26)}{chr(97 + i // 26)}x/{i}" for i in range(200)]
    urls += [f"http://bad.net/news/a{chr(97 + i % 26)}{chr(97 + i // 26)}x/{i}" for i in range(200)]
    more = ["http://bad.net/spam/qqq/7", "http://bad.net/news/qqq/7", "http://other.net/spam/qqq/7"]
    pages = spark.createDataFrame(list(enumerate(urls + more)), "page_id bigint, url string")
    rows = {r.page_id: r for r in url_templates.filtered(pages, rules).collect()}
    assert rows[0].template == "/spam/*/{n}"
    assert [rows[400 + i].verdict for i in range(3)] == ["block", "allow", "allow"]


def test_branches_that_are_alike_are_merged(spark):
    rules = [Rule("block", "h.net", "/a/x"), Rule("block", "h.net", "/b/x"),
             Rule("allow", "h.net", "/a/y"), Rule("allow", "h.net", "/b/y"),
             Rule("block", "h.net", "/c/")]
    urls = [f"http://h.net/{b}/{k}{i}" for b in "abc" for k in "xy" for i in range(50)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    branches = {}
    for r in url_templates.filtered(pages, rules).collect():
        branches.setdefault(r.path[1], set()).add(r.template.split("/")[1])
    assert branches["a"] == branches["b"] and branches["a"] != branches["c"] == {"c"}


def test_pages_of_awkward_rows_and_query(spark):
    pages = spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (None, "http://a.b/" + "s/" * 5000, "y"), (2, "", "z")],
        "page_id bigint, url string, template string",
    )
    assert url_templates.filtered(pages, queries.RULES).count() == 4
    assert url_templates.filtered(pages.limit(0), queries.RULES).count() == 0
    rows = queries.op10_url_templates(spark, "/root/testdata/sf0.001")
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()


def grown(counted, found):
    """Shares of all (host, shape) by loops, with the templates ``found`` by the engine checked
    level by level against tests of siblings."""
    rows = {key: list(key[1]) for key in counted}
    depth = max(len(shape) for _, shape in counted)

    def total(keys):
        return [sum(counted[k][i] for k in keys) for i in range(3)]

    def angle(bad, of):
        return 2 * math.asin(math.sqrt(bad / of))

    for level in range(depth):
        parents = defaultdict(lambda: defaultdict(list))
        for key, template in rows.items():
            if level < len(template):
                parents[key[0], tuple(template[:level])][template[level]].append(key)
        for children in parents.values():
            sums = {segment: total(keys) for segment, keys in children.items()}
            pages = sum(s[0] for s in sums.values())
            names = {}
            if len(sums) >= url_templates.MANY_VALUES and (
                pages <= url_templates.PAGES_PER_VALUE * len(sums)
            ):
                names = dict.fromkeys(sums, "*")
            else:
                group = {segment: "*" for segment, s in sums.items() if s[1]}
                for _ in range(url_templates.TESTS):
                    signs = {}
                    for segment, own in group.items():
                        _, n, bad = sums[segment]
                        rest = [sums[o] for o, g in group.items() if g == own and o != segment]
                        more = sum(s[1] for s in rest)
                        if rest:
                            apart = angle(bad, n) - angle(sum(s[2] for s in rest), more)
                            apart /= math.sqrt(1 / n + 1 / more)
                            signs[segment] = "+" if apart > url_templates.CHANCE else (
                                "-" if apart < -url_templates.CHANCE else "=")
                    group = {s: g + signs.get(s, "") for s, g in group.items()}
                sizes = Counter(group.values())
                names = {s: g for s, g in group.items() if sizes[g] > 1}
            for segment, name in names.items():
                for key in children[segment]:
                    rows[key][level] = name
    assert {k: "/".join(t) for k, t in rows.items()} == found

    prior = url_templates.PRIOR_PAGES
    _, labelled, blocked = total(counted)
    share = dict.fromkeys(counted, blocked / labelled if labelled else 0.0)
    for level in range(depth + 1):
        told, branches = defaultdict(lambda: [0.0, 0.0]), defaultdict(lambda: defaultdict(list))
        for key in counted:
            branches[key[0], tuple(rows[key][:level])][key[1][:level]].append(key)
        evidence = {}
        for (host, branch), prefixes in branches.items():
            for prefix, keys in prefixes.items():
                _, n, bad = total(keys)
                evidence[host, branch, prefix] = (min(n, prior), min(n, prior) * bad / n if n else 0)
                for i in range(2):
                    told[prefix][i] += evidence[host, branch, prefix][i]
        after = {}
        for (host, branch), prefixes in branches.items():
            keys = [k for own in prefixes.values() for k in own]
            pages, n, bad = total(keys)
            others = [
                sum(total(own)[0] * (told[prefix][i] - evidence[host, branch, prefix][i])
                    for prefix, own in prefixes.items()) / pages for i in range(2)
            ]
            before = (others[1] + prior * share[keys[0]]) / (others[0] + prior)
            for key in keys:
                after[key] = round((bad + prior * before) / (n + prior), 9)
        share = after
    return share


def test_templates_and_shares_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    many = [f"http://x{i % 4}.net/u/k{chr(97 + i % 26)}{chr(97 + i // 26)}/{i}" for i in range(90)]
    more = spark.createDataFrame(list(enumerate([*many, None, "", "http://y.com/de/1"])), pages.schema)
    rules = [*queries.RULES, Rule("block", "x1.net", "/u/ka"), Rule("block", "x2.net", "/u")]
    judged = url_templates.ruled(pages.unionByName(more), rules)
    counted = url_templates.shapes(judged).cache()
    plain = {
        (r.host, tuple(r.shape)): (r.pages, r.labelled, r.blocked) for r in counted.collect()
    }
    rows = url_templates.shares(counted).collect()
    found = {(r.host, tuple(r.shape)): "/".join(r.template) for r in rows}
    assert any(t.endswith("/*/{n}") for t in found.values())
    expected = grown(plain, found)
    assert set(expected) == set(found) and len(rows) == len(found)
    assert all(abs(r.share - expected[r.host, tuple(r.shape)]) < 1e-6 for r in rows)


def test_pages_without_a_rule_get_both_verdicts(spark):
    folder = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    rows = queries.op10_url_templates(spark, folder).collect()
    assert len(rows) == pages.count()
    free = [r for r in rows if r.rule is None]
    assert {r.verdict for r in free if r.path.startswith("/es/")} == {"block"}
    assert {r.verdict for r in free if r.path.startswith(("/en/", "/fr/"))} == {"allow"}
    counted = url_templates.shapes(url_templates.ruled(pages, queries.RULES)).cache()
    least = url_templates.bound(counted)
    assert least in url_templates.BOUNDS
    over = url_templates.held_out(counted).where(f"share >= {least}").groupBy().sum().first()
    assert over["sum(bad)"] >= url_templates.PURE * over["sum(known)"]
    print("held out", least, over)


def test_no_label_rejects_nothing(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 9}.net/a/{i}") for i in range(99)],
                                  "page_id bigint, url string")
    assert {r.verdict for r in url_templates.filtered(pages, []).collect()} == {"allow"}


# --- pipeline ----------------------------------------------------------------------


def test_pipeline_stages_by_brute_force(spark):
    from test_llm_dart_minhash import classes
    from test_llm_learned import base
    from test_llm_phrase_index import words

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        own = words(r.text)
        windows |= {tuple(own[i : i + 10]) for i in range(max(len(own) - 9, min(len(own), 1)))}
    sizes = {len(w) for w in windows}

    def leaked(text):
        own = words(text)
        return any(tuple(own[i : i + n]) in windows for n in sizes for i in range(len(own) - n + 1))

    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns
        old = {r.doc_id: r for r in before.collect()}
        new = {r.doc_id: r for r in after.collect()}
        if name == "language":
            assert set(new) == {i for i, r in old.items() if any(map(str.isalpha, r.text))}
        elif name == "near_duplicates":
            ids = sorted(old)
            assert set(new) == {ids[c] for c in classes([old[i].text for i in ids])}
        elif name == "decontamination":
            assert set(new) == {i for i, r in old.items() if not leaked(r.text)}
        else:
            assert set(new) == set(old)
            assert all(not base(r.text) for r in new.values())
            assert all(new[i].text == r.text for i, r in old.items() if "[secret]" not in new[i].text)
        before = spark.createDataFrame(after.collect(), docs.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, before, folder).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in before.collect()}


def test_pipeline_of_awkward_rows(spark):
    folder = "/root/testdata/sf0.001"
    docs = awkward(spark)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, folder)
            assert frame.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, frame, folder).collect()
