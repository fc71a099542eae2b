"""``python -m planweave --input path[=level] ... --output file``: drawings to one GeoJSON document."""

import sys

from planweave.plans.command import main

sys.exit(main())
