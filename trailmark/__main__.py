"""python -m trailmark NAME SF_DIR: runs a registered query and shows its rows; without arguments, lists the names."""

from __future__ import annotations

import sys

from trailmark import catalog
from trailmark.session import local_session


def main(args: list[str]) -> int:
    names = sorted(catalog.queries())
    if len(args) != 2 or args[0] not in names:
        print("\n".join(names))
        return int(bool(args))
    catalog.queries()[args[0]](local_session(), args[1]).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
