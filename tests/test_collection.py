"""The suite must collect from the root, with any other folder of tests beside it."""

from __future__ import annotations

import pathlib
import re


def test_no_module_imports_conftest():
    """Every folder may have a ``conftest``; importing one by name finds whichever was loaded last."""
    root = pathlib.Path(__file__).parent
    found = [str(f.relative_to(root)) for f in root.rglob("*.py")
             if re.search(r"^\s*(from|import)\s+conftest\b", f.read_text(), re.M)]
    assert found == []
