"""Header and full-text templates of license scans, by SPDX name."""

from __future__ import annotations

from importlib import resources

_GNU = ("{it} is free software: you can redistribute it and/or modify it under the terms of the {license} as "
        "published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version. {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {license} for more "
        "details. You should have received a copy of the {license} along with {it}{end}")
_URL = ". If not, see <https://www.gnu.org/licenses/>."
_ADDRESS = ("; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, "
            "MA 02110-1301 USA.")
_GPL, _LESSER, _AFFERO = (f"GNU {x}General Public License" for x in ("", "Lesser ", "Affero "))
_CC = ("This work is licensed under the Creative Commons {terms} 4.0 International License. To view a copy of this "
       "license, visit http://creativecommons.org/licenses/{path}/4.0/ or send a letter to Creative Commons, PO Box "
       "1866, Mountain View, CA 94042, USA.")


def _gnu(name: str, which: str, version: str, it: str = "This program") -> list[tuple[str, str]]:
    return [(name, _GNU.format(it=it, license=which, version=version, end=end)) for end in (_URL, _ADDRESS)]


#: What files say at their top; several for one name are its variants.
HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
     "KIND, either express or implied. See the License for the specific language governing permissions and "
     "limitations under the License."),
    ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. "
     "See the NOTICE file distributed with this work for additional information regarding copyright ownership. The "
     "ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License."),
    *_gnu("GPL-2.0", _GPL, "2"), *_gnu("GPL-3.0", _GPL, "3"), *_gnu("AGPL-3.0", _AFFERO, "3"),
    *_gnu("LGPL-2.1", _LESSER, "2.1", "This library"), *_gnu("LGPL-3.0", _LESSER, "3", "This library"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
     "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); "
     "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis, "
     "WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing "
     "rights and limitations under the License."),
    *[(f"CC-{code.upper()}-4.0", _CC.format(terms=terms, path=code)) for code, terms in (
        ("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nc", "Attribution-NonCommercial"),
        ("by-nd", "Attribution-NoDerivatives"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"))],
]
#: Short licenses stand in files as a whole or at their top.
SHORT = ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT")
LONG = ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0")


def full_text(name: str) -> str:
    return resources.files(__package__).joinpath("license_texts", f"{name}.txt").read_text("utf-8")


def _affero() -> str:
    """The AGPL's text differs from the GPL's in its name, the way back to the GPL and the network clause."""
    text = full_text("GPL-3.0").replace("GNU General Public License", "GNU Affero General Public License").replace(
        "GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    return text + (
        " 13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision "
        "of this License, if you modify the Program, your modified version must prominently offer all users "
        "interacting with it remotely through a computer network (if your version supports such interaction) an "
        "opportunity to receive the Corresponding Source of your version by providing access to the Corresponding "
        "Source from a network server at no charge, through some standard or customary means of facilitating copying "
        "of software. This Corresponding Source shall include the Corresponding Source for any work covered by version "
        "3 of the GNU General Public License that is incorporated pursuant to the following paragraph.")


def windows() -> list[tuple[str, str]]:
    return HEADERS + [(name, full_text(name)) for name in SHORT]


def wholes() -> list[tuple[str, str]]:
    return [(name, full_text(name)) for name in SHORT + LONG] + [("AGPL-3.0", _affero())]
