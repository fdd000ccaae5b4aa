"""Nothing outside the optional subpackage needs it."""

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_the_rest_does_not_import_llm():
    files = [p for d in ("functions", "operators", "sources", "plans", "streaming") for p in (ROOT / "orogen" / d).rglob("*.py")]
    assert files and not [p for p in files if re.search(r"orogen\.llm|corpus_pipeline", p.read_text())]


def test_no_local_checkpoints_or_prompts():
    files = [*(ROOT / "orogen").rglob("*.py"), ROOT / "__spark_entry__.py"]
    assert not [p for p in files if re.search(r"localCheckpoint|\binput\(", p.read_text())]


def test_names_of_queries_are_unique_and_start_with_ids():
    from orogen.plans import catalog

    assert all(re.match(r"[A-Z]\d\d_", n) for n in catalog.queries())
