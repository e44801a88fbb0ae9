"""Puts the repository's top on the path of the tests and of Spark's Python workers."""

import os
import sys

TOP = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = f"{TOP}:{os.environ.get('PYTHONPATH', '')}"
