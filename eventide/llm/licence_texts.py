"""Licence notices as public licences word them, with the phrase that each must hold."""

from __future__ import annotations

#: Fixed values: (label, notice, mandatory key phrase, base).  The first three are the base
#: phrases of the scan's contract.
NOTICES: tuple[tuple[str, str, str, bool], ...] = (
    ("mit", "Released under the MIT License", "under the MIT License", True),
    ("apache-2", "Licensed under the Apache License, Version 2.0", "Apache License, Version 2", True),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "CC BY-NC", True),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to "
     "do so, subject to the following conditions", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", False),
    ("mit-0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
     "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
     "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS "
     "PROVIDED \"AS IS\"", "furnished to do so. THE SOFTWARE IS PROVIDED", False),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to "
     "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
     "you may not use this file except in compliance with the License", False),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
     "disclaimer", "Redistribution and use in source and binary forms", False),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission", "may be used to endorse or promote products derived from this software", False),
    ("bsd-4", "All advertising materials mentioning features or use of this software must display the following acknowledgement",
     "All advertising materials mentioning features or use of this software", False),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS "
     "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES", "with or without fee is hereby granted. THE SOFTWARE IS PROVIDED", False),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies", "with or without fee is hereby granted, provided that the above copyright notice", False),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3", "GNU General Public License, version 3", False),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2", "GNU General Public License, version 2", False),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License", False),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
     "GNU General Public License as published by the Free Software Foundation; either version 2 of the License", False),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
     "published by the Free Software Foundation", "under the terms of the GNU Lesser General Public License", False),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
     "published by the Free Software Foundation", "under the terms of the GNU Affero General Public License", False),
    ("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",
     "under the terms of the GNU Free Documentation License", False),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
     "this file, You can obtain one at http://mozilla.org/MPL/2.0/", "subject to the terms of the Mozilla Public License", False),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
     "https://www.eclipse.org/legal/epl-2.0", "made available under the terms of the Eclipse Public License", False),
    ("cddl", "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use "
     "this file except in compliance with the License", "subject to the terms of the Common Development and Distribution License", False),
    ("eupl", "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL",
     "Licensed under the EUPL, Version 1", False),
    ("boost", "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at "
     "http://www.boost.org/LICENSE_1_0.txt", "under the Boost Software License, Version 1", False),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
     "documentation covered by this license", "to any person or organization obtaining a copy of the software and accompanying documentation", False),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
     "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely", "Permission is granted to anyone to use this software for any purpose", False),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
     "sell, or distribute this software", "free and unencumbered software released into the public domain", False),
    ("wtfpl", "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can redistribute it and/or "
     "modify it under the terms of the Do What The Fuck You Want To Public License", "Do What The Fuck You Want To Public License", False),
    ("artistic-2", "This library is free software; you may redistribute it and/or modify it under the terms of the Artistic License 2.0",
     "under the terms of the Artistic License 2", False),
    ("perl", "This program is free software; you can redistribute it and/or modify it under the same terms as Perl itself", "under the same terms as Perl itself", False),
    ("psf", "Licensed to PSF under a Contributor Agreement", "Licensed to PSF under a Contributor Agreement", False),
    ("ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1", "licensed under the SIL Open Font License", False),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "licensed under a Creative Commons Attribution 4", False),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "licensed under a Creative Commons Attribution-ShareAlike", False),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
     "licensed under a Creative Commons Attribution-NoDerivatives", False),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     "licensed under a Creative Commons Attribution-NonCommercial", False),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
     "has waived all copyright and related or neighboring rights", False),
    ("odbl", "This database is made available under the Open Database License", "made available under the Open Database License", False),
    ("public-domain", "This file has been placed in the public domain", "has been placed in the public domain", False),
    ("all-rights-reserved", "All rights reserved", "All rights reserved", False),
    ("proprietary", "This software is the confidential and proprietary information of its owner and shall not be disclosed", "confidential and proprietary information of", False),
)
