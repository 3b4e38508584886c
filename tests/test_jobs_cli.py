"""The jobs command line runs end to end in its own process."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_words_job_on_a_text_folder():
    folder = tempfile.mkdtemp(prefix="sg-cli-lines-")
    with open(os.path.join(folder, "part.txt"), "w", encoding="utf-8") as fh:
        fh.write("1\ta\tred\n2\tb\tblue\n3\tc\tred\nshort\n")
    out = tempfile.mkdtemp(prefix="sg-cli-out-")
    env = dict(os.environ, PYTHONPATH=ROOT)
    subprocess.run([sys.executable, "-m", "shopgauge.plans.jobs", "words",
                    "--data", "/root/testdata/sf0.001", "--out", out, "--lines", folder],
                   check=True, cwd=ROOT, env=env, timeout=600, capture_output=True)

    def rows(name):
        d = os.path.join(out, name)
        return [json.loads(line) for f in sorted(os.listdir(d)) if f.startswith("part-")
                for line in open(os.path.join(d, f), encoding="utf-8")]

    assert sorted((r["word"], r["count"]) for r in rows("hot_field")) == [("blue", 1), ("red", 2)]
    assert rows("hot_field_rejects") == [{"lines": 4, "rejected": 1}]
