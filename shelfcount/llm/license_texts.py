"""Wordings of well-known licences, as templates of the licence scan. Fixed values."""

from __future__ import annotations

#: Phrases whose every place counts, and their labels.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

#: (label, wording): statements and notices that a text carries, with the names of holders left out.
NOTICES = [
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0"),
    ("cc-by-nd-4.0", "licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa-4.0", "licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd-4.0", "licensed under CC BY-NC-ND 4.0"),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0-1.0", "CC0 1.0 Universal"),
    ("bsd", "use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    ),
    (
        "bsd-3-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used
        to endorse or promote products derived from this software without specific prior written permission.""",
    ),
    (
        "apache-2.0",
        """you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under
        the License.""",
    ),
    (
        "gpl-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version.""",
    ),
    (
        "gpl-2.0",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
        any later version.""",
    ),
    (
        "lgpl-2.1",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
        option) any later version.""",
    ),
    (
        "agpl-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version.""",
    ),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "zlib",
        """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions""",
    ),
    (
        "bsl-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
        execute, and transmit the Software, and to prepare derivative works of the Software""",
    ),
]
