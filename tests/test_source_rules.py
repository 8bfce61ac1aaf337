"""Guards on the library source: constructs the design rules out."""

import os
import re

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "meterflow")


def _sources():
    for d, _, files in os.walk(ROOT):
        for f in files:
            if f.endswith(".py"):
                p = os.path.join(d, f)
                with open(p) as fh:
                    yield p, fh.read()


def test_no_unchecked_broadcast_local_checkpoint_or_row_udf():
    for path, text in _sources():
        code = "\n".join(line.split("#")[0] for line in text.splitlines())
        assert "F.broadcast(" not in code and 'hint("broadcast")' not in code, path
        assert "localCheckpoint" not in code, path
        assert not re.search(r"@F\.udf|F\.udf\(|@udf\b", code), path
