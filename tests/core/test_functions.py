"""Column functions, conditions and chunk loops against plain Python."""

import hashlib
import json
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import classify, fixed, ids, text
from lakewright.functions.conditions import branch_conditions, parse, show, simplified, simplify
from lakewright.operators import index
from lakewright.sources import text as text_source


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def values(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_names(spark):
    df = column(spark, [" a b. ", "X.,", None, "", "\tq\n"])
    assert values(df, text.upper_name(F.col("c"))) == ["A B.", "X.,", "", "", "Q"]
    assert values(df, text.upper_name_or_null(F.col("c"))) == ["A B.", "X.,", None, None, "Q"]
    assert values(df, text.paragraph_name(F.col("c")))[:2] == ["A B", "X."]


def test_paths(spark):
    df = column(spark, ["D:\\src\\PROG.cbl", "/a/b/c.tar.gz", "plain", ".hidden", "a/.env"])
    assert values(df, text.path_stem(F.col("c"))) == ["PROG", "c.tar", "plain", ".hidden", ".env"]


def test_identifiers_leave_out_words_and_literals(spark):
    df = column(spark, ["IF WS-A = 'TEXT' AND EIBAID = DFHPF3 GO TO X-1", 'move "A B" to c1 d', None])
    assert values(df, text.identifiers(F.col("c"))) == [["WS-A", "EIBAID", "DFHPF3", "X-1"], ["C1"], None]


def test_quote_aware_cuts(spark):
    df = column(spark, ["A='x <== y' <== note", "K=1  rest  more", "plain", "'open  quote"])
    body, note = text.inline_note(F.col("c"))
    assert values(df, body)[0] == "A='x <== y'" and values(df, note)[0] == "note"
    body, note = text.continuation_note(F.col("c"))
    assert values(df, body)[1:] == ["K=1", "plain", "'open  quote"] and values(df, note)[1] == "rest more"


def split_slowly(s):
    out, held, depth, quoted = [], "", 0, False
    for ch in s:
        if ch == "'":
            quoted = not quoted
        elif not quoted and ch == "(":
            depth += 1
        elif not quoted and ch == ")" and depth:
            depth -= 1
        elif not quoted and ch == "," and not depth:
            out.append(held.strip())
            held = ""
            continue
        held += ch
    return [x for x in [*out, held.strip()] if x]


def test_operands_split_where_a_scanner_splits(spark):
    random.seed(1)
    texts = ["".join(random.choice(["A=", "B", ",", "(X,Y)", "'q,r'", " ", "((1,2),3)", "C"]) for _ in range(random.randrange(12))) for _ in range(150)]
    assert values(column(spark, texts), text.top_level_items(F.col("c"))) == [split_slowly(t) for t in texts]
    _, keyword = text.operands(F.col("c"))
    assert values(column(spark, ["dsn=A,DSN=B  note,X"]), keyword) == [{"DSN": "B"}]


def test_ids(spark):
    df = column(spark, ["a", None])
    assert values(df, ids.joined_id(F.lit("P"), F.col("c"))) == [hashlib.sha256(f"P||{v}".encode()).hexdigest()[:16] for v in ("a", None)]
    assert values(df, ids.short_blake(F.col("c"))) == [hashlib.blake2b(b"a", digest_size=8).hexdigest(), None]
    doc = {"b": [1, "ü"], "a": None}
    got = values(column(spark, [json.dumps(doc), "{bad"]), ids.canonical_json(F.col("c")))
    assert got == [json.dumps(doc, sort_keys=True, ensure_ascii=False), None]
    assert values(column(spark, ["x"]), ids.comment_id(F.lit("P"), F.lit(7), F.lit("inline"), F.col("c"))) == ["program.comment.P.7." + hashlib.sha1(b"P|7|inline|x").hexdigest()[:12]]


@pytest.mark.parametrize(
    ("before", "after"),
    [
        ("X = 'I' OR 'A' OR 'C'", "(X = 'I') OR (X = 'A') OR (X = 'C')"),
        ("NOT (A NOT GREATER B)", "A GREATER B"),
        ("(X = 'I') AND (X = 'A')", "(X = 'I') OR (X = 'A')"),
        ("NOT (X = 'I') AND X = 'I'", ""),
        ("A = 1 OR B = 2 OR (A = 1)", "(A = 1) OR (B = 2)"),
        ("A = 1 OR (A = 1 AND B = 2)", "A = 1 AND B = 2"),
        ("((A = 1", "A = 1"),
        ("A = 1))", "A = 1"),
        ("T(I) = 'X' AND (B = 1 OR C = 2).", "T(I) = 'X' AND (B = 1 OR C = 2)"),
        ("A NOT = SPACE AND", "A NOT = SPACE"),
    ],
)
def test_conditions_are_simplified_by_rule(before, after):
    assert simplified(before) == after


_atoms = st.sampled_from(["A = 1", "B = '2'", "C NOT = D", "E GREATER F"])
_trees = st.recursive(_atoms, lambda s: st.one_of(st.tuples(s, s).map(lambda t: f"({t[0]}) AND ({t[1]})"), st.tuples(s, s).map(lambda t: f"({t[0]}) OR ({t[1]})"), s.map(lambda t: f"NOT ({t})")), max_leaves=6)


@settings(max_examples=150, deadline=None)
@given(_trees)
def test_simplified_conditions_stay_as_they_are(condition):
    once = simplified(condition)
    assert simplified(once) == once or once == ""
    assert once.count("(") == once.count(")")
    assert show(parse(show(parse(condition)))) == show(parse(condition))
    assert simplify(None) is None


def test_branches():
    lines = """
           IF A = 1
              GO TO P1.
           IF A = 2 AND
              B = 3 THEN
              GO TO P2.
           GO TO P9.
           IF X = 'Y'
              IF Z = 1
                 GO TO P3
              ELSE
                 GO TO P4
              END-IF
           END-IF.
           GO TO P5.
    """.splitlines()
    got = branch_conditions(lines)
    assert got["P1"] == "A = 1" and got["P2"] == "A = 2 AND B = 3"
    assert got["P9"] == "NOT (A = 1 OR (A = 2 AND B = 3))"
    assert got["P3"] == "X = 'Y' AND Z = 1"
    assert "P5" not in got
    # An IF that other statements and then a GO TO end stays open: what follows still counts as inside it.
    assert branch_conditions(["IF A = 1", "MOVE 1 TO C", "GO TO P1.", "GO TO P2."]) == {"P1": "A = 1", "P2": "A = 1"}


def chunk_slowly(s, size, overlap):
    out, at = [], 0
    while s:
        out.append(s[at : at + size])
        if at + size >= len(s):
            break
        at += size - overlap
    return out


@pytest.mark.parametrize(("size", "overlap"), [(10, 3), (10, 0), (10, 5), (10, 9), (1, 0)])
def test_fixed_chunks_are_a_loop(spark, size, overlap):
    texts = [None, "", "a", "x" * 9, "x" * 10, "x" * 11, "äöü🎉\n" * 13, "".join(map(str, range(60)))]
    df = column(spark, texts)
    got = {}
    for r in index.fixed_chunks(df, "i", "c", size, overlap).collect():
        got.setdefault(r.i, {})[r.chunk_index] = r.chunk
        assert r.chunk_count == len(chunk_slowly(texts[r.i], size, overlap))
    assert {i: [c for _, c in sorted(v.items())] for i, v in got.items()} == {i: chunk_slowly(t, size, overlap) for i, t in enumerate(texts) if t}


def test_soft_chunks_are_cut_in_parts(spark):
    """What is sent back together is bounded by bytes, not by the 10,000 rows of a batch."""
    sizes = []

    class Rows:
        schema = T.StructType([T.StructField("i", T.IntegerType())])

        def select(self, *_):
            return self

        def mapInArrow(self, cut, schema):
            texts = [None, "", *["Some words. " * 5_000] * 200, None, "x" * 9_000_000, "end"]
            batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int32()), pa.array(texts)], ["i", "t"])
            out = list(cut(iter([batch])))
            sizes.extend(b.nbytes for b in out)
            return pa.Table.from_batches(out).to_pylist()

    rows = index.soft_chunks(Rows(), "i", "t", 1200, 120)
    assert len(sizes) > 5 and sorted(sizes)[-2] < 3 << 20
    assert [r["chunk"] for r in rows if r["i"] == 5] == index.soft_spans("Some words. " * 5_000, 1200, 120)
    assert [r["i"] for r in rows if r["chunk"] in ("", "end")] == [1, 204] and {r["i"] for r in rows} == set(range(205)) - {0, 202}


def test_soft_chunks_end_at_sentences(spark):
    s = "One sentence here. " * 30
    parts = index.soft_spans(s, 100, 20)
    assert all(len(p) <= 100 for p in parts) and all(p.endswith(".") for p in parts)
    assert parts[0] == s[:95].strip() and s.strip().endswith(parts[-1])
    assert index.soft_spans("short", 100, 20) == ["short"] and index.soft_spans("x" * 250, 100, 90)[1] == "x" * 100
    rows = index.soft_chunks(column(spark, [None, "", s]), "i", "c", 100, 20).collect()
    assert [r.chunk for r in sorted(rows) if r.i == 2] == parts and not any(r.i == 0 for r in rows)


def test_anchor_chunks_snap_to_anchors():
    assert index.anchor_spans(100, 40, 5, [35, 70]) == [(0, 35), (35, 70), (70, 100)] or index.anchor_spans(100, 40, 5, [35, 70])[0] == (0, 35)
    spans = index.anchor_spans(500, 60, 10, list(range(0, 500, 25)))
    assert spans[0][0] == 0 and spans[-1][1] == 500
    assert all(a[1] >= b[0] and a[0] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_flattening():
    doc = {"b": {"x": 1, "y": [True, "s", None, {"z": ""}]}, "a": "", "n": [], "e": {}}
    assert list(index.flattened(doc, "content")) == ["content.a: \"\"", "content.b.x: 1", "content.b.y: true, s", "content.b.y[0]: null", "content.b.y[1].z: \"\""]
    assert list(index.flattened([{"i": 1}] * 122, "r"))[-1] == "r: ... 2 more complex items not expanded"
    deep = {"a": {"a": {"a": {"a": {"a": {"a": {"a": 1}}}}}}}
    assert list(index.flattened(deep)) == ['a.a.a.a.a.a: {"a": 1}']


def test_comment_classes(spark):
    texts = ["MOVE A TO B.", "01 WS-X PIC X.", "WORKING-STORAGE SECTION", "M A P P E", "PDCUST01", "AREA DI LAVORO", "TOTALE DEL MESE", "Reads the next order, if there is one.", "Calcola il totale"]
    got = [r.classification for r in classify.with_comment_class(column(spark, texts), "c").orderBy("i").collect()]
    assert got == ["commented_out_code"] * 2 + ["section_header"] * 2 + ["name_or_reference", "descriptive_header", "descriptive_header", "explanatory_comment", "explanatory_comment"]


def test_readiness(spark):
    rows = [(None, None, None, None, "UNKNOWN"), (1, 0, True, True, "NOT_READY"), (0, 0, True, False, "NOT_READY"), (0, 2, True, True, "READY_WITH_WARNINGS"), (0, 0, False, None, "READY")]
    df = spark.createDataFrame(rows, "f long, w long, c boolean, v boolean, want string")
    assert all(r.got == r.want for r in df.withColumn("got", classify.readiness(F.col("f"), F.col("w"), F.col("c"), F.col("v"))).collect())


def test_preview(spark):
    df = column(spark, [[], ["a", "", None], list("abcdef")], "array<string>")
    assert values(df, text.preview(F.col("c"))) == ["none", "a", "a, b, c, d (+2 more)"]
    assert re.fullmatch("12.3%", values(column(spark, ["x"]), text.percent(F.lit(0.1234)))[0])


def test_comment_class_shortcuts_decide_as_the_whole_rules(spark):
    random.seed(8)
    words = "to FROM move value COMP-3. Pic x usage end-if. the A B C level 01 fd * ** / -- until. suppress, Straße ſet varyıng thru by. ABC. IS-1. end".split() + ["\t", "\u2003", "\u3000", "\x1c", "\xa0"]
    clauses = re.findall("[A-Z]+(?:-[A-Z]+)?", fixed.CLAUSE.replace("(-[1-9])?", ""))
    lines = ["", None, *words, *[f"a {c.lower()} to." for c in clauses], *[random.choice(["", " "]).join(x) if random.random() < 0.1 else random.choice([" ", "  "]).join(x) for x in ([random.choice(words) for _ in range(random.randint(1, 6))] for _ in range(3_000))]]
    df = column(spark, lines).withColumn("raw", F.btrim(F.regexp_replace(F.coalesce("c", F.lit("")), r"(?U)\s+", " "), F.lit(fixed.WHITE)))
    df = df.withColumn("bare", F.btrim(F.regexp_replace(F.regexp_replace("raw", r"^[*/\s]+", ""), r"[\s*]+$", ""), F.lit(fixed.WHITE)))
    df = classify.with_comment_class(df, "c").withColumn("code", classify.is_code(F.col("bare"))).withColumn("want", classify.code_score(F.col("bare")) >= 4)
    structural = F.col("bare").rlike("(?i)" + fixed.DIVISION) | F.col("bare").rlike("(?i)" + fixed.SECTION)
    df = df.withColumn("whole", classify._comment_class(F.col("bare"), F.col("raw"), classify._words(F.col("bare")), structural))
    rows = df.select("c", "raw", "bare", text.collapse(F.col("c")).alias("collapsed"), classify.bare_comment(F.col("c")).alias("b"), "code", "want", "whole", "classification").collect()
    assert not [r for r in rows if (r.collapsed, r.b, r.code, r.classification) != (r.raw, r.bare, r.want, r.whole)]
    assert {r.classification for r in rows} >= {"commented_out_code", "name_or_reference", "descriptive_header", "explanatory_comment"} and {r.want for r in rows} == {True, False}


def test_lines_split_a_text_once(spark):
    plan = text_source.lines(column(spark, ["a\nb\n"]), "i", "c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1  # 3 before
