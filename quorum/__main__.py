from quorum.cli import main

raise SystemExit(main())
