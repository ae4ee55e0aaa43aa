import sys

from flowguard.cli import main

sys.exit(main())
