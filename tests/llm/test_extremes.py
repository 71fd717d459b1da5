"""Inputs at the edge: vectors of any finite scale, markup that is not well formed, odd column names."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlake.llm import embed_join, html_text, mixing


def test_vectors_of_any_scale(spark):
    """Directions decide, not lengths: the links of scaled vectors are those of the same vectors near length 1."""
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(5, 8))
    plain = [centres[k % 5] + draw.normal(size=8) * 0.2 for k in range(60)] + [np.ones(8), np.ones(8) * 2]
    scales = [1e-200, 1e200, 1.0, 1e307, 1e-300]
    rows = [(k, (v * scales[k % 5]).tolist(), 1) for k, v in enumerate(plain[:-2])] + [(60, [1e200] * 8, 1), (61, [2e200] * 8, 1)]
    rows += [(70, [5e-324] * 8, 1), (71, [5e-324] * 4 + [0.0] * 4, 1), (72, [1e-200] * 8, 1), (73, [1e308] + [1e-308] * 7, 1), (74, [1.0] + [0.0] * 7, 1), (75, [0.0] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_join.near_vectors(df, 0.93).collect()}
    unit = {i: np.array(v) / np.abs(v).max() for i, v, _ in rows if any(v)}
    unit = {i: v / np.sqrt(v @ v) for i, v in unit.items()}
    links = {i: {j for j, w in unit.items() if j != i and v @ w >= 0.93} for i, v in unit.items()}
    assert all(got[i][0] == len(x) for i, x in links.items()) and got[75] == (0, 75)
    assert got[61][0] >= 3 and got[70][1] == got[60][1] == got[72][1] and got[73][1] == got[74][1]


@pytest.mark.parametrize("source, texts", [
    ("<p>x<!--->tail</p><p>more</p>", ["xtail", "more"]), ("<p>x<!-->tail</p><p>more</p>", ["xtail", "more"]), ("<p>x<!-- a --!>tail</p>", ["xtail"]),
    ("<p>x<!-- a -- b -->tail</p>", ["xtail"]), ("<p>x<!----></p><p>y</p>", ["x", "y"]), ("<p>x<!-- open</p><p>y", ["x"]),
    ("<p>a<script src=/a/b/>code</script>b</p>", ["a b"]), ("<p>a<textarea/>typed</textarea>b</p>", ["a b"]), ("<p>a<title/>t</title>b</p>", ["a b"]),
    ("<p>a<svg width=1/>b</p>", ["ab"]), ("<p>a<svg><text>t</text></svg>b</p>", ["a b"]), ("<p>a<iframe src=x/>in</iframe>b</p>", ["a b"]),
])
def test_markup(source, texts):
    assert [t for t in html_text.Page(source).text if t] == texts


@pytest.mark.parametrize("source", ["<div>" * 100_000 + "</table>" * 100_000, "<div>" * 30_000 + "<td>x</td>" * 30_000, "<p>" * 100_000 + "</li>" * 100_000, "<ul><li>" * 30_000 + "</ol>" * 100_000])
def test_broken_pages_take_linear_time(source):
    began = time.process_time()
    html_text.Page(source)
    # Seconds even on a slow machine; searching the stack for each end tag took minutes.
    assert time.process_time() - began < 10


def test_dotted_columns_survive_the_mix(spark):
    rows = [(i, "w " * (i % 5), "ab"[i % 2], i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, `meta.size` int, `odd``name` int")
    got = mixing.mix_rows(df, weights=(5, 2, 1), share=1.5, most=2.0)
    assert got.columns == df.columns
    assert got.select(F.col("`meta.size`").alias("x")).agg(F.count("x")).first()[0] == got.count() > 0
