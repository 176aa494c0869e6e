"""spark-submit entry script: ``spark-submit job.py run --source .. --root ..``.

Only the driver imports ``strata``: the jobs use no Python functions on
executors, so nothing needs shipping with ``--py-files``.
"""

import sys

from strata.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
