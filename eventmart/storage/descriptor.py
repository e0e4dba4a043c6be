"""A small file that says what kind of table a folder is."""

import json

NAME = "_table.json"


def describe(files, path, **fields):
    """Note the kind and parameters of a table with its first batch."""
    if not files.exists(f"{path}/{NAME}"):
        files.write_text(f"{path}/{NAME}", json.dumps(fields))


def described(files, path):
    """What `describe` noted, or None."""
    return json.loads(files.read_text(f"{path}/{NAME}")) if files.exists(f"{path}/{NAME}") else None
