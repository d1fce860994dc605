import os
import subprocess
import sys


def test_numbering_survives_failed_tasks():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert out.stdout.strip().endswith("OK 4000"), out.stdout[-2000:] + out.stderr[-2000:]
