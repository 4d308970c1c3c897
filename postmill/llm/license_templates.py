"""License wordings as templates. The public texts of the licenses and notices.

``<<optional>>`` to ``<<end>>`` may be left out, ``<<var;min;max>>`` stands for that many
words of any kind. All else is mandatory.
"""

#: Phrases whose places are always counted, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Pairs of label and template; a label may have several.
TEMPLATES = (
    (
        "mit-text",
        """<<optional>>Copyright <<optional>>(c)<<end>> <<var;0;12>><<end>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice <<optional>>(including the next
        paragraph)<<end>> shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;1;12>> BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
        FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
        SOFTWARE.""",
    ),
    (
        "isc-text",
        """<<optional>>Copyright <<optional>>(c)<<end>> <<var;0;12>><<end>>
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;1;8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL <<var;1;8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "bsd-text",
        """<<optional>>Copyright <<optional>>(c)<<end>> <<var;0;12>><<end>>
        <<optional>>All rights reserved.<<end>>
        Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: <<optional>>1.<<end>>
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. <<optional>>2.<<end>> Redistributions in binary
        form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.
        <<optional>><<optional>>3.<<end>> Neither the name of <<var;1;12>> nor the names of its
        contributors may be used to endorse or promote products derived from this software without
        specific prior written permission.<<end>>
        THIS SOFTWARE IS PROVIDED BY <<var;1;12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    (
        "zlib-text",
        """This software is provided 'as-is', without any express or implied warranty. In no event
        will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely""",
    ),
    (
        "unlicense-text",
        """This is free and unencumbered software released into the public domain. Anyone is free
        to copy, modify, publish, use, compile, sell, or distribute this software, either in source
        code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
        any means.""",
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License<<optional>>, Version<<end>> 2.0<<optional>> (the
        "License"); you may not use this file except in compliance with the License. You may obtain
        a copy of the License at <<var;1;12>> Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied<<end>>""",
    ),
    (
        "gpl",
        """<<optional>><<var;1;12>> is free software; <<end>>you can redistribute it and/or modify
        it under the terms of the GNU General Public License as published by the Free Software
        Foundation; either version <<var;1;2>> of the License, or (at your option) any later
        version""",
    ),
    (
        "lgpl",
        """you can redistribute it and/or modify it under the terms of the GNU <<var;1;1>> General
        Public License as published by the Free Software Foundation; either version <<var;1;2>> of
        the License, or (at your option) any later version""",
    ),
    (
        "gpl-3.0",
        """licensed under the <<optional>>terms of the <<end>>GNU General Public
        License<<optional>> as published by the Free Software Foundation<<end>><<optional>>,
        version<<end>> 3""",
    ),
    (
        "gpl-2.0",
        """licensed under the <<optional>>terms of the <<end>>GNU General Public
        License<<optional>> as published by the Free Software Foundation<<end>><<optional>>,
        version<<end>> 2""",
    ),
    ("mit-notice", "<<optional>>This <<var;1;4>> is<<end>> licensed under the <<optional>>terms of the<<end>> MIT License"),
    ("mit-notice", "released under the <<optional>>terms of the<<end>> MIT License"),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        <<optional>>If a copy of the MPL was not distributed with this file, You can obtain one at
        <<var;1;8>><<end>>""",
    ),
    ("cc-by-4.0", "licensed under <<optional>>a<<end>> <<optional>>Creative Commons<<end>> <<optional>>Attribution<<end>> CC BY 4.0"),
    ("cc-by-nc-4.0", "licensed under <<optional>>a<<end>> <<optional>>Creative Commons<<end>> <<optional>>Attribution NonCommercial<<end>> CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under <<optional>>a<<end>> <<optional>>Creative Commons<<end>> <<optional>>Attribution ShareAlike<<end>> CC BY-SA 4.0"),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 <<optional>>International<<end>> License"),
    ("cc-by-nc-4.0", "Creative Commons Attribution NonCommercial 4.0 <<optional>>International<<end>> License"),
    ("cc-by-sa-4.0", "Creative Commons Attribution ShareAlike 4.0 <<optional>>International<<end>> License"),
    ("cc0-1.0", "Creative Commons <<optional>>CC0 1.0<<end>> Universal <<optional>>Public Domain Dedication<<end>>"),
    ("all-rights-reserved", "<<optional>>Copyright <<optional>>(c)<<end>> <<var;0;12>><<end>> All rights reserved"),
)
