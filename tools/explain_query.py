"""Print the executed (final adaptive) plan of catalogue queries.

    python tools/explain_query.py [sf_dir] query [query ...]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from quire.plans import catalogue
    from quire.session import local_session
    spark = local_session(8)
    for name in names:
        df = catalogue.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
