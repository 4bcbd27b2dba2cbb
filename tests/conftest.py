from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("OMP_NUM_THREADS", "1")  # before numpy comes in
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from hydrapix.session import get_session

    return get_session("tests", "4", 4)
