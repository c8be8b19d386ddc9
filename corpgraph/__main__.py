"""``python -m corpgraph COMMAND ...``"""

from corpgraph.cli import main

if __name__ == "__main__":
    main()
