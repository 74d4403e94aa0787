"""``python -m paylens --data <tables> --out <shared folder>``: the end-to-end run."""

from paylens.plans.run import main

if __name__ == "__main__":
    main()
