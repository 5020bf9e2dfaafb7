import sys

from mdmspark.cli import main

sys.exit(main())
