"""The text without its host's common lines."""

import pytest

from pawprint.llm import line_rules
from tests.llm.conftest import with_extra


@pytest.mark.parametrize("host", ["h", None])
def test_cleaned_text(spark, host):
    rows = [(i, host, f"Menu  {i:02d}\n\nown words {'ab'[i % 2]} of {'x' * i}\n  menu\nMenu {i:02d}")
            for i in range(60)]
    rows += [(5, host, rows[5][2]), (100, host, None), (101, host, ""), (102, host, "Menu 77"),
             (103, "g", "Menu 77\nmore"), (None, host, "alone\n")]
    docs = with_extra(spark.createDataFrame(rows, "doc_id long, source string, text string")
                      ).drop("host")
    got = line_rules.cleaned(docs)
    assert got.columns == ["doc_id", "source", "text"]
    want = [(d, s, t if d is None or d >= 100 else f"\nown words {'ab'[d % 2]} of {'x' * d}")
            for d, s, t in rows]
    want[[r[0] for r in rows].index(102)] = (102, host, "")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert line_rules.cleaned(docs.limit(0)).count() == 0
