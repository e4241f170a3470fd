import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("sitegrain.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, ".")
import sitegrain.catalog
print(len(sitegrain.catalog.QUERIES))
"""


def test_the_core_stands_without_the_training_operators():
    out = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout) > 80


def test_nothing_else_imports_them():
    others = [p for p in ROOT.glob("sitegrain/**/*.py") if "llm" not in p.parts]
    assert others and not [p for p in others if "sitegrain.llm" in p.read_text()]
