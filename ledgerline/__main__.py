import sys

from ledgerline.cli import main

sys.exit(main())
