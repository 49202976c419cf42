import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_the_entry_loads_without_a_library_of_the_training_data_operators():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(*e.queries())"
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    names = found.stdout.split()
    assert "enriched_quotes" in names and not any(n.startswith("op") for n in names)
    assert "zstandard" in found.stderr or "training-data" in found.stderr
