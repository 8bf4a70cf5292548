"""Run the queries that use Python workers from a folder in which the package cannot be imported:
`python tests/check_foreign.py`, from anywhere."""

import os
import sys
import tempfile
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)

if __name__ == "__main__":
    os.chdir(tempfile.mkdtemp())
    sys.path[:] = [p for p in sys.path if p not in ("", str(Path(ROOT) / "tests"))] + [ROOT]
    import __spark_entry__ as entry
    from millrace.session import build_session

    spark = build_session("foreign", "local[4]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    for name in ("recover_record", "retry_attempts", "state_process", "reg_register", "batch_buffer"):
        print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
    spark.stop()
