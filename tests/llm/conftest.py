import ctypes
import sys

import pytest

M_TRIM_THRESHOLD = -1


@pytest.fixture(scope="session", autouse=True)
def heap_stays():
    """The heap of the test process shrinks only when it is told to. Small arrays do not see to that once earlier tests have left holes for them."""
    if sys.platform == "linux" and hasattr(ctypes.CDLL(None), "mallopt"):
        ctypes.CDLL(None).mallopt(M_TRIM_THRESHOLD, 1 << 30)
