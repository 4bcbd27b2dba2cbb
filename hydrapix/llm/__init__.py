"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

The networks trained on the driver multiply small matrices, where several BLAS threads only get in each other's way: they
get one thread unless the process has chosen otherwise, or has loaded numpy before.
"""

import os

os.environ.setdefault("OMP_NUM_THREADS", "1")
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
