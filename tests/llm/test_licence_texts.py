"""Licences in their real texts, wrapped as they usually stand."""

from __future__ import annotations

import pytest

from sparkmart.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS), EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""


@pytest.mark.parametrize(
    ("text", "name", "end"),
    [
        (MIT, "MIT", "SOFTWARE."),
        (BSD, "BSD", "SUCH DAMAGE."),
        (APACHE, "Apache-2.0", "under the License."),
        (GPL, "GPL-2", "for more details."),
        (GPL.replace("; you can", ": you can").replace("General", "Lesser General").replace("program", "library"), "LGPL-2", "for more details."),
        (MPL, "MPL-2.0", "MPL/2.0/."),
        ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0", "License."),
    ],
)
def test_wrapped_texts(text, name, end):
    for before, after in (("", ""), ("Some lines\nwithout a mark\n", "\nmore lines\nbelow"), ("é É words. ", " More words.")):
        (got, first, last), = licenses.licences(before + text + after)
        assert got == name
        inside = (before + text + after)[first:last]
        assert inside.endswith(end) and first <= len(before) + 3


def test_sentences_that_only_mention_a_licence():
    assert licenses.licences("The software was good. A license is needed to drive.\nNobody was licensed under the MIT License of old.") == []


FSF_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {}General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {}General Public License for more details.

You should have received a copy of the GNU {}General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""


@pytest.mark.parametrize("kind, name", [("", "GPL-3"), ("Lesser ", "LGPL-3"), ("Affero ", "AGPL-3")])
def test_notices_of_version_3(kind, name):
    text = FSF_3.format(kind, kind, kind)
    for own in (text, " ".join(text.split()), text.replace("\n", "\n# ")):
        assert [n for n, _, _ in licenses.licences("Some words before.\n\n" + own)] == [name]


@pytest.mark.parametrize(
    "text, name",
    [
        ("Code is licensed under the MIT License.", "MIT"),
        ("The documentation is available under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("The software is distributed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Content is available under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ],
)
def test_grants_of_other_words(text, name):
    assert [n for n, _, _ in licenses.licences(f"Read this. {text} And that.")] == [name]


def test_talk_of_licences_is_no_licence():
    for text in ("She has a licence for the software.", "We talked about the GNU General Public License.", "The MIT License is short.", "A driver is licensed under the law."):
        assert licenses.licences(text) == []
