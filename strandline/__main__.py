"""``python -m strandline <job> ...``: the command-line jobs of :mod:`strandline.cli`."""

import sys

from strandline.cli import main

sys.exit(main())
