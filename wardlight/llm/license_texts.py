"""Licence texts and notices that scans look for."""

# Licence names as notices write them, by SPDX identifier.
NAMES = {
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3",
                 "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPL-3.0"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License",
                   "Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "BSD-3-Clause"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0",
                     "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0",
                     "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0",
                "GPL v2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0",
                "GPL v3", "GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL v3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}

# How notices lead up to a name.
LEADS = ["Licensed under", "Released under", "Distributed under", "Available under",
         "Published under", "This work is licensed under", "This software is licensed under",
         "This project is licensed under", "This file is licensed under",
         "This text is licensed under", "This document is licensed under",
         "This software is released under", "This work is released under",
         "Licensed under the terms of", "Released under the terms of",
         "Distributed under the terms of", "SPDX-License-Identifier:"]

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution.\n")
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted{}\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
    "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")

# Whole licence texts, without title and copyright line.
TEXTS = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\nThe above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software.\n" + _WARRANTY),
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": (
        _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.\n" + _BSD_TAIL),
    "ISC": _ISC.format(", provided that the above copyright notice and this permission notice "
                       "appear in all copies."),
    "0BSD": _ISC.format("."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software.\n"
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:\n1. The origin of this software must not be misrepresented; you "
        "must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not "
        "required.\n2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software.\n3. This notice may not be removed or "
        "altered from any source distribution."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at\n"
        "http://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.\nThis program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.\nYou should have received a copy of the "
        "GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."),
}

# Spellings that mean the same in a licence.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "cancelled": "canceled", "catalogue": "catalog", "centre": "center", "colour": "color",
    "emphasise": "emphasize", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize",
    "judgement": "judgment", "labour": "labor", "licence": "license", "licences": "licenses",
    "licenced": "licensed", "modelling": "modeling", "organisation": "organization",
    "organisations": "organizations", "practise": "practice", "programme": "program",
    "realise": "realize", "recognise": "recognize", "whilst": "while", "https": "http",
    "noncommercial": "non commercial", "sublicence": "sublicense",
}

# SHA-256 of whole canonical licence texts that are too long to be written out here.
DIGESTS = {
    "Apache-2.0":
        "5274d681217584fa715cb9348f5102af445120d28cbce4ffd507dda487052ace",
    "Artistic-1.0-Perl":
        "21855feb11db0e3b57fdea8a8c2abd4cecb6c3f37325639cce5a8e1105acc9dc",
    "CC0-1.0":
        "5caa6b96e2c9f66e9ca02d726096312a8662a9c4fea6446ff24fee66902e58dc",
    "GFDL-1.2":
        "e91eb5f9d5d9856213578f733f5ae52f5692c9fc3cc1b05d048aff37a05aaeea",
    "GFDL-1.3":
        "5e719d42b044f5a2be4336c9e91d4860266cc46522216361f4c9ccbb621b3657",
    "GPL-1.0":
        "39aae49b2b94c81dace84712786827ed636c0e2e7d0409dbebdeeb934cbbbdfe",
    "GPL-2.0":
        "d64d715caaf3aabcb303c869c931e4a2e70408db6130a5fa767c43fc3c2be1f5",
    "GPL-3.0":
        "20c0929055cf1d6cda1b3b50b1ba7ce765ba48a01db32da4fbc8e9d36b83f273",
    "LGPL-2.0":
        "50b16baab608d8704ffcb3d5903977ff69ee3f6e7979d31163a0d22a9f122068",
    "LGPL-2.1":
        "c86b71074833e3972dc24fb47e85c81816737892868619f2d8c7e85727bc8677",
    "LGPL-3.0":
        "572947626844a56d29ace510237040204d4085696621f319533ca366aa897913",
    "MPL-1.1":
        "3e1d583b23b6d724af773ca0ceabeb4e31fc565080dfee40ad0701a48af1a915",
    "MPL-2.0":
        "1f9b7661552309dc69cee928f7d32ed3280cbc918bfeced108b8b7d3f68f5452",
}
