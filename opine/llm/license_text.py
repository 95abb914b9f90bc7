"""The words of well-known licence notices, and the phrases they must hold."""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    """A notice that carries `label`. `key_phrases` must stand at their places in it; a base phrase is its own key."""

    name: str
    label: str
    text: str
    key_phrases: tuple[str, ...]
    base: bool = False


# Fixed values. Base phrases: every place where their words stand consecutively counts.
BASE = (
    Template("base-gpl", "gpl", "gnu general public license", ("gnu general public license",), True),
    Template("base-apache", "apache", "apache license", ("apache license",), True),
    Template("base-cc-by", "cc-by", "cc by", ("cc by",), True),
    Template("base-mit", "mit", "mit license", ("mit license",), True),
)

# Fixed values. Notices as their licences word them, in words of a-z, 0-9 and non-ASCII characters.
NOTICES = (
    Template(
        "mit-grant",
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge",),
    ),
    Template(
        "apache-2-header",
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
        ("apache license version 2 0",),
    ),
    Template("apache-2-line", "apache-2.0", "under the apache license version 2 0", ("apache license version 2 0",)),
    Template(
        "gpl-3-header",
        "gpl-3.0",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
        ("gnu general public license", "either version 3 of the license"),
    ),
    Template(
        "gpl-2-header",
        "gpl-2.0",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 2 of the license or at your option any later version",
        ("gnu general public license", "either version 2 of the license"),
    ),
    Template("gpl-3-line", "gpl-3.0", "gnu general public license version 3", ("public license version 3",)),
    Template("gpl-2-line", "gpl-2.0", "gnu general public license version 2", ("public license version 2",)),
    Template("lgpl-line", "lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl-line", "agpl", "gnu affero general public license", ("gnu affero general public license",)),
    Template("mpl-2-line", "mpl-2.0", "mozilla public license version 2 0", ("mozilla public license",)),
    Template(
        "bsd-grant",
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc-grant",
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("distribute this software for any purpose with or without fee",),
    ),
    Template(
        "unlicense-grant",
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    Template("cc0-line", "cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    Template("cc-by-nc-line", "cc-by-nc", "under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa-line", "cc-by-sa", "under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd-line", "cc-by-nd", "under cc by nd 4 0", ("cc by nd",)),
    Template(
        "cc-by-name",
        "cc-by",
        "creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
)
