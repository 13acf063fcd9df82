"""Wordings by which licences are stated, as templates for the licence scan."""

# Public licence notices and grants, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation",
    ),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
]

# Phrases that name a licence wherever they stand.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
