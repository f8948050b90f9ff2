"""What teaches the models is none of the tables' own sentences."""

import inspect
import re
from pathlib import Path

import pytest

from opinlake.llm import mainbody, pii, prose, toxic, toxic_seeds

LONGEST = 12
FOLDER = Path("/root/testdata/sf0.1")


def _strings():
    """Fixed texts of the training material: seeds, cue words, and every literal of the modules that make training material."""
    out = set(toxic_seeds.phrases()) | set(toxic_seeds.clean())
    for m in (pii, toxic_seeds, mainbody, prose, toxic):
        code = re.sub(r'""".*?"""', "", inspect.getsource(m), flags=re.S)
        for x in re.findall(r'"((?:[^"\\\\\n]|\\\\.)*)"', code):
            out |= {p for p in re.split(r"[|{}]", x)}
    return {x.strip().lower() for x in out if len(x.strip()) > LONGEST and re.search(r"[^\W\d_]", x)}


def test_no_fixed_sentence_stands_in_the_tables():
    pq = pytest.importorskip("pyarrow.parquet")
    ahocorasick = pytest.importorskip("ahocorasick")
    if not FOLDER.exists():
        pytest.skip("no test data here")
    found = ahocorasick.Automaton()
    for x in _strings():
        found.add_word(x, x)
    found.make_automaton()
    hits = set()
    for name, columns in (("unified_rows", ["comment_text", "text"]), ("documents", ["text"]), ("raw_posts", ["raw_text"])):
        for c in columns:
            for t in set(pq.read_table(FOLDER / f"{name}.parquet", columns=[c]).column(0).to_pylist()):
                if t:
                    hits |= {x for _, x in found.iter(t.lower())}
    assert not hits
