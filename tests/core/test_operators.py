"""Relational, graph, job and record operators on small inputs, skewed and odd ones included."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lakewright import sinks
from lakewright.operators import checkpoint, documents, graph, jobs, quality, relational
from lakewright.plans import fixture_queries, program, table_queries
from lakewright.plans.fixtures import FIXTURES, frame
from lakewright.sources import cobol, facts, text
from lakewright.sources import documents as json_source

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("strictly", [False, True])
def test_filling_forward_in_buckets_is_filling_forward(spark, strictly):
    random.seed(2)
    rows = [("hot" if random.random() < 0.7 else random.choice("ab"), i, random.choice([None, None, i])) for i in range(400)] + [(None, 1, 5), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    plain = relational.fill_forward(df, ["k"], ["o"], F.col("v"), "got", strictly=strictly)
    dealt = relational.fill_forward(df, ["k"], ["o"], F.col("v"), "got", bucket=F.floor(F.col("o") / 7), strictly=strictly)
    key = lambda r: (r.k or "", r.o)
    assert [tuple(r) for r in sorted(plain.collect(), key=key)] == [tuple(r) for r in sorted(dealt.collect(), key=key)]
    want, last = {}, defaultdict(lambda: None)
    for k, o, v in rows:
        want[k, o] = last[k] if strictly or v is None else v
        last[k] = last[k] if v is None else v
    assert {(r.k, r.o): r.got for r in dealt.collect()} == want


@pytest.mark.parametrize("side", ["before", "after"])
def test_nearest_is_brute_force(spark, side):
    random.seed(3)
    left = [(random.choice("ab"), random.randrange(40), i) for i in range(30)] + [("a", None, 90)]
    right = [(random.choice("ab"), random.randrange(40), 100 + i) for i in range(60)]
    make = lambda rows: spark.createDataFrame(rows, "k string, t int, id int")
    got = {(r.l_id, r.place): r.r_id for r in relational.nearest(make(left), make(right), ["k"], "t", 3, side, "id").collect()}
    want = {}
    for k, t, i in left[:-1]:
        own = [(rt, ri) for rk, rt, ri in right if rk == k and (rt <= t if side == "before" else rt >= t)]
        for place, (_, ri) in enumerate(sorted(own, reverse=side == "before")[:3], 1):
            want[i, place] = ri
    assert got == want


def test_contains_join_is_brute_force(spark):
    random.seed(4)
    word = lambda: random.choice(["aa", "ab", "b", "ccc"])
    texts = [" ".join(word() for _ in range(random.randrange(1, 60))) for _ in range(60)] + ["", "xaa ab by", "日本 語x"]
    passages = [" ".join(word() for _ in range(random.randrange(1, 8))) for _ in range(30)] + ["a ab b", "nowhere at all in any text", "", "b", "a", "c c", "ab b", "本 語", "cc aa a"]
    a = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    b = spark.createDataFrame(list(enumerate(passages)), "j int, passage string")
    got = {(r.i, r.j) for r in relational.contains_join(a, b, "body", "passage").collect()}
    assert got == {(i, j) for i, t in enumerate(texts) for j, p in enumerate(passages) if p in t}


def test_prefix_join_and_first_by_priority(spark):
    names = spark.createDataFrame([("A-B-C",), ("A",), ("AB",)], "name string")
    found = relational.prefix_join(names, spark.createDataFrame([("A",), ("A-B",)], "p string"), "name", "p").collect()
    assert {tuple(r) for r in found} == {("A-B-C", "A"), ("A-B-C", "A-B"), ("A", "A")}
    wanted = spark.createDataFrame([(1, ["x", "y"]), (2, ["q"]), (3, [])], "id int, key array<string>")
    have = spark.createDataFrame([("y", "fy"), ("x", "fx2"), ("x", "fx1")], "key string, file string")
    assert {r.id: r.file for r in relational.first_by_priority(wanted, have, "key", "file").collect()} == {1: "fx1", 2: None, 3: None}


def test_reachability_loops_agree_on_cycles(spark):
    random.seed(5)
    edges = spark.createDataFrame([(p, str(random.randrange(20)), str(random.randrange(20))) for p in "pq" for _ in range(18)], "program string, src string, dst string")
    roots = spark.createDataFrame([("p", "0"), ("q", "1"), ("z", "alone")], "program string, node string")
    one, many = graph.reachable(edges, roots), graph.reachable_by_program(edges, roots)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in many.collect()}
    assert one.where("program = 'z'").count() == 1
    chain = spark.createDataFrame([("p", str(i), str(i + 1)) for i in range(20)], "program string, src string, dst string")
    assert graph.reachable(chain, roots.where("program = 'p'")).count() == 21  # more rounds than stand apart


def test_comparison_of_graphs(spark):
    nodes = lambda *n: spark.createDataFrame([("g", x) for x in n], "key string, node string")
    edges = lambda *e: spark.createDataFrame([("g", a, b) for a, b in e], "key string, src string, dst string")
    got = graph.compare(nodes("A", "B"), edges(("A", "B")), nodes("A", "B", "C"), edges(("A", "B"), ("B", "C"))).first()
    assert (got.status, got.edge_recall, got.edge_precision, got.extra_nodes) == ("RIGHT_SUPERSET", 1.0, 0.5, 1)
    same = graph.compare(nodes("A", "B"), edges(("A", "B")), nodes("A", "B"), edges(("A", "B")))
    card = graph.scorecard(same, "ours", "theirs").first()
    assert card.alignment == 1.0 and card.profile == "theirs is effectively identical to ours."
    alone = graph.compare(nodes("A"), edges(("A", "A")), nodes("A").where("false"), edges(("A", "A")).where("false")).first()
    assert alone.status == "LEFT_ONLY"


def test_overrides_replace_and_add(spark):
    lines = frame(spark, "fx_cobol")
    programs = text.program_names(lines)
    order = cobol.raw_paragraph_order(lines, programs).join(programs, "file")
    own = spark.createDataFrame([("BILLRUN", "BILLRUN", "FIRST-PHASE", "JUMP", "KNOWN = 1", "e"), ("BILLRUN", "X", "Y", "JUMP", None, "e")], "program string, src string, dst string, type string, condition string, evidence string")
    got = {(r.src, r.dst): r for r in graph.enriched(graph.extract(lines)[1], cobol.raw_paragraph_lines(lines, programs), order, own).collect()}
    assert got["BILLRUN", "FIRST-PHASE"].condition == "KNOWN = 1" and ("X", "Y") in got and got["INIT-RUN", "INIT-RUN-MID"].type == "RANGE_FLOW"


def test_job_lineage(spark):
    a = jobs.analyse(frame(spark, "fx_jcl"))
    assert {tuple(r)[2:] for r in a["flow"].collect()} == {("MAKE", "PSTEP", "PROD.BILLS", "produces_input_for"), ("MAKE", "LAST", "PROD.BILLS", "deleted_after")}
    ran = [(r.execution_order, r.step, r.invoked_by_step) for r in a["executed"].where("file LIKE '%BILL%'").orderBy("execution_order").collect()]
    assert ran == [(1, "CLEAN", None), (2, "MAKE", None), (3, "PSTEP", "PRINT"), (4, "SEND", None), (5, "LAST", None)]
    catalog = {r.dsn: r for r in a["catalog"].collect()}
    assert catalog["PROD.ORDERS2"].external_input and not catalog["PROD.BILLS"].external_input and catalog["&&WORK"].dataset_kind == "temporary"
    checked = {r.job: r for r in jobs.validation(a).collect()}
    assert checked["BILLJOB"].flags == ["procedure_resolvable_in_batch", "unknown_dd_usage"] and checked["OTHER"].flags == ["unresolved_procedure"]
    context = a["step_comments"].collect()
    assert [r.comment_context for r in context] == [["First the old file goes"]]
    assert {r.type for r in jobs.job_documents(a).collect()} == {"jcl_job", "jcl_step", "jcl_dataset", "jcl_warning"}


def test_records_and_documents(spark):
    recs = facts.records(frame(spark, "fx_facts"))
    assert {r.program for r in recs.collect()} == {"UNKNOWN", "BILLRUN", "TAXCALC"}
    m = {r.program: r for r in facts.metrics(recs).collect()}
    assert (m["BILLRUN"].loc, m["BILLRUN"].statements, m["BILLRUN"].paragraphs) == (120, 34, 9) and m["TAXCALC"].statements is None
    other = facts.unhandled(recs).first()
    assert (other.rec, other.n, other.examples) == ("MYSTERY", 2, ["MYSTERY,a", "mystery,b"])
    docs = documents.fact_documents(recs)
    rows = {(r.type, r.title): r for r in docs.collect()}
    assert len(rows) == docs.count() == len({r.id for r in rows.values()})
    assert rows["architecture.call", "BILLRUN CICSLINK -> PRI,CE"].evidence == ['CALL,u9,p1,BILLRUN,CICSLINK,"PRI,CE"']
    assert rows["architecture.database", "TAXCALC database footprint"].embedding_text.endswith("light_db_usage_likely_validation_or_constant_select (conf=0.7).")
    assert rows["program.summary", "BILLRUN overview"].evidence[0].startswith("FILE,") and len(rows["program.summary", "BILLRUN overview"].evidence) == 6
    assert documents.of_type(docs, "program.summary", "billrun", first=True).count() == 1


def test_json_sources(spark):
    files = spark.createDataFrame([("a", '[{"id": 1}, 5, {"id": 2}]'), ("b", '{"id": 3}'), ("c", "not json"), ("d", "7"), ("e", None)], "file string, text string")
    got = json_source.json_documents(files).select("file", "json_index", F.to_json("doc").alias("d")).collect()
    assert sorted((r.file, r.json_index, r.d) for r in got) == [("a", 0, '{"id":1}'), ("a", 1, '{"id":2}'), ("b", 0, '{"id":3}')]
    assert {r.file for r in json_source.invalid_json(files).collect()} >= {"c"}
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(['{"id":"1","program":"P","type":"t","text":"x","metadata":{}}', '{"id":"1","text":""}', "{bad", "[1]", "  "])], "file string, line_no int, raw string")
    q = quality.json_line_quality(json_source.json_lines(lines)).first()
    assert (q.line_count, q.invalid_lines, q.duplicate_ids, q.empty_text, q.missing_required_fields, q.valid) == (4, 2, 1, 1, 1, False)
    good = '{"graph": {"name": "g"}, "nodes": ["A"], "edges": [{"from": "A", "to": "A"}]}'
    bad = '{"nodes": ["A", "A"], "edges": [{"from": "A", "to": "B"}]}'
    problems = {r.file: r.problems for r in json_source.graph_problems(spark.createDataFrame([("g", good), ("h", bad), ("i", "x")], "file string, text string")).collect()}
    assert problems == {"g": [], "h": ["missing_graph_name", "edge_of_unknown_node", "duplicate_nodes"], "i": ["invalid_json"]}


def test_file_sources_and_sinks(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "A.CBL").write_bytes(b"line one\r\n\xff two\n")
    (tmp_path / "b.cbl").write_bytes("PROGRAM-ID. BB.\nü\x0bz".encode())
    (tmp_path / "c.txt").write_text("no")
    files = text.read_files(spark, str(tmp_path), (".cbl",), fallback="latin")
    got = {r.file.rsplit("/", 1)[1]: r.text for r in files.collect()}
    assert got == {"A.CBL": "line one\r\nÿ two\n", "b.cbl": "PROGRAM-ID. BB.\nü\x0bz"}
    assert text.lines(files).count() == 5
    assert {r.program for r in text.program_names(text.lines(files)).collect()} == {"A", "BB"}
    windows = text.read_files(spark, str(tmp_path), (".cbl",), fallback="windows")
    assert "ÿ two" in {r.file.rsplit("/", 1)[1]: r.text for r in windows.collect()}["A.CBL"]
    df = spark.createDataFrame([("k", 1, True, ["a"]), ("l", None, False, [])], "k string, n int, b boolean, xs array<string>")
    sinks.json_lines(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    sinks.by_entity(df, str(tmp_path / "by"), "k")
    assert (tmp_path / "by" / "k=l").exists()
    sinks.pretty_json(df, str(tmp_path / "pretty"))
    assert "| k | n | b | xs |" in sinks.markdown(df, "T") and "| k | 1 | yes | a |" in sinks.markdown(df)
    assert "n" in sinks.scorecard(df, "T")


def test_streams(spark, tmp_path):
    from lakewright.streaming import files

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x" * 25)
    stream = files.chunk_stream(files.file_stream(spark, str(tmp_path / "in")), 10, 2)
    for _ in range(2):  # a second run finds nothing new
        files.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
        assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_locations_and_folders(spark):
    names = spark.createDataFrame([("a",), ("B",), ("c",)], "name string")
    sources = spark.createDataFrame([("x/a.cbl",), ("x/b.cbl",), ("y/B.cbl",)], "file string")
    assert {r.name: r.status for r in quality.located(names, sources).collect()} == {"A": "FOUND", "B": "AMBIGUOUS", "C": "MISSING"}
    rows = lambda *r: spark.createDataFrame(list(r), "key string, content string")
    assert {r.key: r.status for r in quality.compare_folders(rows(("a", "1"), ("b", "2"), ("c", "3")), rows(("a", "1"), ("b", "x"), ("d", ""))).collect()} == {"a": "SAME", "b": "DIFFERENT", "c": "LEFT_ONLY", "d": "RIGHT_ONLY"}


def test_small_checks_the_size(spark):
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(relational.small(spark.range(5), 10)) and "broadcast" not in plan(relational.small(spark.range(50), 10))
    assert checkpoint.checkpointed(spark.range(3)).count() == 3


def test_every_fixture_query_runs_on_every_run_alike(spark):
    for name in ("rule_documents", "call_parameters", "program_comments", "index_records", "jcl_notes"):
        once, again = (sorted(map(str, fixture_queries.QUERIES[name](spark, SF).collect())) for _ in range(2))
        assert once and once == again, name
    assert set(FIXTURES) and not set(fixture_queries.QUERIES) & set(table_queries.QUERIES)


def test_entry_has_a_stable_schema(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["doc_id", "chunk_index", "chunk_count", "lang", "id", "content_hash"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def _holders(df):
    """Steps of a plan that hold rows in a task's memory."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(plan.count(w) for w in (" Sort [", "Aggregate(", "Window ["))


def test_program_relations_cut_their_plans(spark):
    """No task holds the buffers of the whole analysis, also where the session's cache was emptied since."""
    planned = []
    keep = lambda df: (planned.append(_holders(df)), checkpoint.checkpointed(df))[1]
    program.program_relations(frame(spark, "fx_cobol"), keep=keep)
    assert max(planned) <= 120  # 275 where statements and order were planned anew for every use
    fixture_queries._program(spark)
    spark.catalog.clearCache()
    # 335, 384, 994 and 1,234 where what was kept went with the cache.
    for name, most in {"var_read_write": 10, "variable_records": 20, "comment_documents": 30, "global_map_documents": 150}.items():
        assert _holders(fixture_queries.QUERIES[name](spark, SF)) <= most, name


def test_structure_documents_stay_cut(spark):
    jobs_, program_ = fixture_queries._jobs(spark), fixture_queries._program(spark)
    spark.catalog.clearCache()
    assert max(map(_holders, (jobs_["step_datasets"], program_["edges"], program_["sites"]))) <= 5
    assert _holders(fixture_queries.QUERIES["structure_documents"](spark, SF)) <= 150  # 2,961 where what was kept went with the cache


def test_graph_diff_deals_out_what_it_compares(spark, monkeypatch):
    """One pass over the lines, in pieces by their number; the session's shuffle partitions (4 here) don't decide a task's share."""
    plan = lambda: table_queries.QUERIES["graph_diff"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan().count("FileScan parquet") == 1  # 6 scans and 5 large aggregates before
    monkeypatch.setattr(graph, "PIECE_ITEMS", 1_000)
    assert "REPARTITION_BY_NUM" in plan() and "hashpartitioning(key" in plan() and ", 12)" in plan()  # 4,000 lines of A and R, three items each


def test_graph_items_are_the_comparison_of_their_graphs(spark, monkeypatch):
    random.seed(3)
    monkeypatch.setattr(graph, "PIECE_ITEMS", 10)
    name = lambda n: random.choice([None, *range(n)])
    rows = [(random.choice(["OF", "F"]), random.choice([None, 1, 2]), name(6), name(8), random.choice("ARN")) for _ in range(300)]
    line = spark.createDataFrame(rows, "l_linestatus string, l_linenumber int, l_suppkey long, l_partkey long, l_returnflag string")
    monkeypatch.setattr(table_queries, "table", lambda *_: line)
    say = lambda mark, c: F.concat(F.lit(mark), F.col(c).cast("string"))
    edges = lambda flag: line.where(F.col("l_returnflag") == flag).select(F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("key"), say("s", "l_suppkey").alias("src"), say("p", "l_partkey").alias("dst"))
    nodes = lambda e: e.select("key", F.col("src").alias("node")).union(e.select("key", "dst"))
    want = graph.compare(nodes(edges("A")), edges("A"), nodes(edges("R")), edges("R"))
    got = table_queries._graphs(spark, SF)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
