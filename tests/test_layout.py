from pathlib import Path

ROOT = Path(__file__).resolve().parents[1] / "citeloom"


def test_nothing_else_imports_the_training_data_subpackage():
    for path in ROOT.rglob("*.py"):
        if ROOT / "llm" not in path.parents:
            text = path.read_text()
            assert "citeloom.llm" not in text and "from .llm" not in text and "from ..llm" not in text, path


def test_no_local_checkpoint_and_no_cross_join():
    for path in ROOT.rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and "crossJoin" not in text, path
