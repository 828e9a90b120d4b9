"""Thin wrapper: ``python tools/compare.py [sf_dir] [name ...]``."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierload.compare import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
