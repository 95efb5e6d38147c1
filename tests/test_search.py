import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shardleaf.operators import search as op
from shardleaf.plans import prefixes, shared_dir
from shardleaf.sources import nested_entries, read_index, read_shard, section_catalog, symbol_entries, write_index

from conftest import rows

# The sections of a documentation site and the first characters in use.
CHARS = {
    0: "25acdefghijlmnoprstuvz~", 1: "flnps", 2: "m", 3: "f", 4: "acdfgimnoprstvz~", 5: "filmns", 6: "ds", 7: "acgz", 8: "2aghijlmnoprst",
}
NAMES = {0: "all", 1: "classes", 2: "namespaces", 3: "files", 4: "functions", 5: "variables", 6: "enums", 7: "enumvalues", 8: "pages"}
LABELS = {0: "All", 1: "Classes", 2: "Namespaces", 3: "Files", 4: "Functions", 5: "Variables", 6: "Enumerations", 7: "Enumerator", 8: "Pages"}


@pytest.fixture(scope="module")
def catalog(spark):
    return section_catalog(spark, NAMES, LABELS, CHARS)


@pytest.fixture(scope="module")
def entries(spark):
    data = [
        ("functions", "get", "a.html#1", "A::get"), ("functions", "get", "b.html#1", "B::get"), ("functions", "Get_all", "b.html#2", "B"),
        ("functions", "~A", "a.html#9", "A"), ("pages", "Getting started", "p.html", ""), ("pages", "éa", "q.html", ""), ("pages", "", "r.html", ""),
        ("pages", " get off", "s.html", ""),
    ]
    df = spark.createDataFrame(data, "section string, label string, url string, scope string")
    return symbol_entries(df, "label", "url", "scope", F.col("section"))


def q(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid int, q string")


def test_catalog_facts(catalog):
    sizes = {r["name"]: len(r["shard_chars"]) for r in catalog.collect()}
    assert (len(sizes), sizes["all"], sum(sizes.values())) == (9, 23, 72)
    assert rows(op.catalog_audit(catalog)) == [("5", "all_only"), ("e", "all_only"), ("u", "all_only")]


def test_shards_by_first_character(spark, catalog):
    asked = spark.createDataFrame([("  Alpha", 0), ("~x", 0), ("x", 2), ("", 0), ("q", 99)], "q string, section_id int")
    got = {r["q"]: (r["shard"], r["pos"], r["shard_name"]) for r in op.assign_shards(asked, catalog).collect()}
    assert got == {"  Alpha": ("a", 2, "all_2"), "~x": ("~", 22, "all_16"), "x": ("x", -1, None), "": (None, -1, None), "q": ("q", -1, None)}


def test_prefix_search(entries):
    assert rows(op.prefix_search(entries, " GET "), "label") == [("Get_all",), ("Getting started",), ("get off",), ("get",), ("get",)]
    assert rows(op.prefix_search(entries, "get_"), "label") == [("Get_all",)]
    assert rows(op.prefix_search(entries, "getting s"), "label") == [("Getting started",)]
    assert rows(op.section_search(entries, "pages", "É"), "label") == [("éa",)]
    assert op.prefix_search(entries, "  ").count() == 0
    assert op.prefix_search(entries, "====").count() == 0


def test_batch_join_equals_single_searches(spark, entries):
    texts = ["get", " Ge", "~", "zzz", "", "é", "get_", "getting started and more", "a"]
    found = op.batch_prefix_join(q(spark, *texts), entries)
    for i, text in enumerate(texts):
        mine = found.where(F.col("qid") == i).select(entries.columns)
        assert rows(mine) == rows(op.prefix_search(entries, text)), text


def test_counts_and_first(spark, entries):
    counts = {r["qid"]: r for r in op.match_counts(q(spark, "get", "zzz", "", "get"), entries).collect()}
    assert [(counts[i]["n_matches"], counts[i]["n_targets"], counts[i]["no_match"]) for i in range(4)] == [
        (4, 5, False), (0, 0, True), (0, 0, True), (4, 5, False)
    ]
    assert rows(op.first_match(q(spark, "get", "zzz", "~a"), entries), "qid", "label", "url") == [(0, "get", "a.html#1"), (2, "~A", "a.html#9")]


def test_queries_stay_in_their_section(spark, entries):
    asked = q(spark, "get", "get").withColumn("section", F.when(F.col("qid") == 0, "pages").otherwise("functions"))
    assert rows(op.batch_prefix_join(asked, entries), "qid", "section", "label") == [
        (0, "pages", "Getting started"), (0, "pages", "get off"), (1, "functions", "Get_all"), (1, "functions", "get"), (1, "functions", "get")
    ]
    assert rows(op.match_counts(asked, entries), "qid", "n_matches") == [(0, 2), (1, 2)]


def test_the_section_all_is_every_section(spark, entries):
    twice = entries.unionByName(entries)
    found = op.section_search(twice, "all", "get")
    assert rows(found, "section", "label", "url") == rows(op.all_section(op.prefix_search(entries, "get")), "section", "label", "url") and found.count() == 5
    asked = q(spark, "get", "get").withColumn("section", F.when(F.col("qid") == 0, "all").otherwise("functions"))
    joined = op.batch_prefix_join(asked, twice)
    assert rows(joined.where("qid = 0").select(entries.columns)) == rows(found)
    assert joined.where("qid = 1").count() == 6
    assert rows(op.match_counts(asked, entries), "qid", "n_matches") == [(0, 4), (1, 2)]


def test_null_sections_count_in_all(spark):
    df = spark.createDataFrame([(None, "x", "u"), ("s", "y", "u"), ("s", "y", "u")], "section string, label string, url string")
    flat = symbol_entries(df, "label", "url", F.lit(""), F.col("section"))
    assert rows(op.all_section(flat), "section", "label") == [("all", "x"), ("all", "y")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\u00a0aBÉİ_9%&\U0001F600", min_size=1, max_size=8), min_size=1, max_size=15))
def test_every_label_is_found_by_its_prefixes(spark, labels):
    df = spark.createDataFrame([*enumerate(labels)], "url int, label string")
    flat = symbol_entries(df, "label", "url", F.lit(""), "s")
    kept = {r.url: r.label for r in flat.collect()}
    asked = [(f"{u}:{n}", u, text[:n]) for u, text in kept.items() for n in range(1, len(text) + 1) if text[:n].strip(" ")]
    asked += [(f"{u}:raw", u, text.lower()) for u, text in kept.items() if text]
    found = op.batch_prefix_join(spark.createDataFrame([(a, t) for a, _, t in asked], "qid string, q string"), flat) if asked else None
    hits = {(r.qid, r.url) for r in found.collect()} if asked else set()
    assert all((a, str(u)) in hits for a, u, _ in asked)
    for u, text in list(kept.items())[:2]:
        if text:
            assert str(u) in {r.url for r in op.prefix_search(flat, text).collect()}


def test_large_paths_give_the_same(spark, entries, monkeypatch):
    """Many lengths, many shards and queries too big to broadcast: other plans, same rows."""
    asked = q(spark, "get", "g", "ge", "gettin", "~", "none", "é")
    expected = [rows(f(asked, entries)) for f in (op.batch_prefix_join, op.match_counts, op.first_match)]
    monkeypatch.setattr(op, "MAX_ROWS", 0)
    monkeypatch.setattr(op, "PRUNE_SHARDS", 1)
    assert [rows(f(asked, entries)) for f in (op.batch_prefix_join, op.match_counts, op.first_match)] == expected


def test_nesting_and_back(spark, entries):
    groups = op.group_results(entries)
    got = {r["label"]: (r["n_targets"], r["is_group"], [t["scope"] for t in r["targets"]]) for r in groups.collect()}
    assert got["get"] == (2, True, ["A::get", "B::get"]) and got["~A"] == (1, False, ["A"])
    assert rows(nested_entries(groups)) == rows(entries)


def test_big_groups_come_in_parts(spark):
    data = [("s", "hot", f"u{i % 50}", "x") for i in range(200)] + [("s", "cold", "u", "x"), (None, None, "n", "x")]
    df = spark.createDataFrame(data, "section string, label string, url string, scope string")
    flat = symbol_entries(df, "label", "url", "scope", F.col("section"))
    groups = op.group_results(flat, per_part=10).collect()
    hot = [g for g in groups if g["label"] == "hot"]
    assert len(hot) > 1 and {g["n_targets"] for g in hot} == {200}
    assert sorted(t["url"] for g in hot for t in g["targets"]) == sorted({f"u{i}" for i in range(50)})
    assert sum(t["copies"] for g in hot for t in g["targets"]) == 200
    assert [(g["n_targets"], g["is_group"]) for g in groups if g["label"] != "hot"] == [(1, False), (1, False)]
    parts = [[t["url"] for t in g["targets"]] for g in sorted(hot, key=lambda g: g["part"])]
    assert sum(parts, []) == sorted(f"u{i}" for i in range(50)) and {len(p) for p in parts} == {10}, "parts go on in target order"
    assert rows(nested_entries(op.group_results(flat, per_part=10))) == rows(flat)


def test_item_index_with_split_groups(spark):
    data = [("s", f"a{i % 40:02d}", f"u{i % 7}", "x") for i in range(300)] + [("s", "b", "u", "x"), ("t", None, "u", "x")]
    df = spark.createDataFrame(data, "section string, label string, url string, scope string")
    flat = symbol_entries(df, "label", "url", "scope", F.col("section"))
    plain = rows(op.item_index(flat))
    assert len(plain) == 302
    assert rows(op.item_index(flat, max_rows=20)) == plain
    top = [r for r in plain if r[1] == "a"]
    assert {r[-1] for r in top} == set(range(40))


def test_all_section_drops_copies(spark, entries):
    twice = entries.unionByName(entries)
    assert op.all_section(twice).count() == entries.count()
    assert rows(op.build_catalog(entries)) == [("functions", "g~"), ("pages", "gé")]


@pytest.fixture(scope="module")
def stored(spark, entries):
    path = shared_dir(spark, "index-test")
    write_index(entries, path)
    return path


def test_index_round_trip(spark, entries, stored):
    assert rows(read_index(spark, stored)) == rows(entries.where("shard is not null"))
    assert rows(read_shard(spark, stored, "pages", "É"), "label") == [("éa",)]
    assert read_shard(spark, stored, "pages", "x").count() == 0
    assert read_shard(spark, stored, "nowhere", "g").count() == 0


def test_number_like_shards_stay_text(spark):
    df = spark.createDataFrame([("2d", "u", "s"), ("2e", "u", "s")], "label string, url string, scope string")
    path = shared_dir(spark, "index-test")
    write_index(symbol_entries(df, "label", "url", "scope", "numbers"), path)
    assert rows(read_shard(spark, path, "numbers", "2"), "shard", "label") == [("2", "2d"), ("2", "2e")]


def test_shards_that_are_not_plain_folder_names(spark):
    labels = ["/x", "%y", "=z", "*w", ".v", ":u", "\\t", "\"s", "#r", "é"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    path = shared_dir(spark, "index-test")
    write_index(symbol_entries(df, "label", "label", F.lit("s"), "odd"), path)
    assert rows(read_index(spark, path), "label") == sorted(((x,) for x in labels), key=repr)
    for x in labels:
        assert rows(op.section_search(read_index(spark, path), "odd", x), "label") == [(x,)]


def test_search_reads_one_folder_and_pushes_the_prefix(spark, stored):
    plan = op.section_search(read_index(spark, stored), "functions", "get")._jdf.queryExecution().executedPlan().toString()
    scan = op.section_search(read_index(spark, stored), "functions", "get").inputFiles()
    assert "StringStartsWith(match_name,get)" in plan and "shard" in plan.split("PartitionFilters:")[1][:200]
    assert scan


def test_a_popular_letter_is_cut_into_files(spark):
    df = spark.range(5000).select(F.concat(F.lit("the "), "id").alias("label"), F.lit("u").alias("url"), F.lit("s").alias("scope"))
    path = shared_dir(spark, "index-test")
    write_index(symbol_entries(df, "label", "url", "scope", "hot"), path, files=6)
    names = {r[0] for r in read_index(spark, path).select(F.input_file_name()).distinct().collect()}
    assert len(names) == 6


def test_many_query_joins_broadcast_only_what_was_measured(spark, entries):
    plan = op.batch_prefix_join(q(spark, "get", "a"), entries)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def named(spark, names, sections=("s", "t")):
    """Entries under given match names and shards, some names several times under several labels and targets."""
    data = [
        (sections[n % len(sections)], name[:1].lower(), f"id{n % 3}", name, f"label {n % 5}", f"u{n}", True, "x")
        for n, name in enumerate(names)
    ]
    return spark.createDataFrame(data, "section string, shard string, id string, match_name string, label string, url string, same_frame boolean, scope string"), data


def plain_answers(data, queries):
    counts, firsts = [], []
    for qid, q, *section in queries:
        text = q.strip(" ").lower()
        found = [d for d in data if text and d[1] == text[0] and d[3].startswith(text)]
        if section and section[0] == "all":
            found = list({("all", *d[1:]) for d in found})
        elif section:
            found = [d for d in found if d[0] == section[0]]
        items = {(d[0], d[1], d[2], d[4], d[3]) for d in found}
        counts.append((qid, len(items), len(found), not found))
        if found:
            best = min(found, key=lambda d: [x.encode() if isinstance(x, str) else x for x in (d[3], d[4], d[0], d[2], d[7], d[5])])
            firsts.append((qid, best[3], best[4], best[0], best[5]))
    return sorted(counts, key=repr), sorted(firsts, key=repr)


@pytest.mark.parametrize("max_rows", [None, 7])
def test_counts_and_firsts_by_rank(spark, max_rows):
    """Prefixes of prefixes, names at both ends of a shard, the last characters there are, one shard split into parts."""
    draw = random.Random(11)
    names = ["".join(draw.choice("abé\U0010ffff") for _ in range(draw.randint(1, 5))) for _ in range(150)]
    names += ["a", "a", "ab", "aba", "a\U0010ffff", "a\U0010ffff\U0010ffff", "b" * 40]
    entries, data = named(spark, names)
    asked = sorted({n[:k] for n in names for k in (1, 2, 3, len(n))}) + ["", " ", "zz", "abz", " a ", "bbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbb"]
    queries = [(i, q) for i, q in enumerate(asked) if "_" not in q]
    frame = spark.createDataFrame(queries, "qid int, q string")
    counts, firsts = plain_answers(data, queries)
    assert rows(op.match_counts(frame, entries, max_rows)) == counts
    assert rows(op.first_match(frame, entries, max_rows), "qid", "match_name", "label", "section", "url") == firsts
    picked = [(i, q, ("s", "t", "all", "none")[i % 4]) for i, q in queries]
    frame = spark.createDataFrame(picked, "qid int, q string, section string")
    counts, firsts = plain_answers(data, picked)
    assert rows(op.match_counts(frame, entries, max_rows)) == counts
    assert rows(op.first_match(frame, entries, max_rows), "qid", "match_name", "label", "section", "url") == firsts


def test_counts_copy_no_entry(spark, monkeypatch):
    """No plan of match_counts or first_match generates rows, on whichever side."""
    plans = []
    for module in (prefixes, op):
        real = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, real=real: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    entries, _ = named(spark, ["abc", "abd", "b"])
    frame = spark.createDataFrame([(1, "a"), (2, "abd")], "qid int, q string")
    for found in (op.match_counts(frame, entries), op.first_match(frame, entries)):
        found.collect()
        plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 6 and not any("Generate" in p for p in plans)
