import sys

from trailmart.cli import main

sys.exit(main())
